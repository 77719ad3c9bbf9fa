"""The queries of this subpackage and the SQL of those that SQL can express."""

from kinveil.llm.bpe import op4_bpe
from kinveil.llm.exact_topk import OP8_SQL, op8_exact_topk
from kinveil.llm.language_id import op2_language_id
from kinveil.llm.media import op5_media
from kinveil.llm.mixing import op7_mixing
from kinveil.llm.ngram_join import OP9_SQL, op9_ngram_jaccard
from kinveil.llm.sharding import op3_sharding
from kinveil.llm.substring_dedup import op1_substring_dedup
from kinveil.llm.token_count import op10_token_count
from kinveil.llm.url_filter import OP6_SQL, op6_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_language_id,
        op3_sharding,
        op4_bpe,
        op5_media,
        op6_url_filter,
        op7_mixing,
        op8_exact_topk,
        op9_ngram_jaccard,
        op10_token_count,
    )
}

OP1_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
k as (select doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) h from w, unnest(range(1, len(ws) - 48)) t(i)),
m as (select h, min(doc_id) least from k group by h),
gone as (select distinct k.doc_id, k.i + j.j p from k join m using (h), range(0, 50) j(j) where k.doc_id > m.least),
tok as (select doc_id, p, ws[p] x from w, unnest(range(1, len(ws) + 1)) t(p)),
kept as (select tok.doc_id, count(*) n, string_agg(x, ' ' order by p) s from tok anti join gone using (doc_id, p) group by 1)
select w.doc_id, cast(len(ws) as bigint) n_words, cast(len(ws) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(s, '')) kept_sha256
from w left join kept using (doc_id)
"""

SQL = {
    "op1_substring_dedup": OP1_SQL, "op6_url_filter": OP6_SQL, "op8_exact_topk": OP8_SQL, "op9_ngram_jaccard": OP9_SQL
}
