"""Each stage against what plain Python says of its own input."""

import collections
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.test_mixing import fill
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90001, None, "en", "src1", 0), (90002, "123 !!", None, None, 7), (90003, "", "en", "src1", 0)], docs.schema)
    docs = docs.unionByName(odd)
    names = docs.columns
    for name, f in cp.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = cp.stage(f(spark, docs, SF), "test")
        after = [r.asDict() for r in docs.collect()]
        assert after
        if name != "encoding":
            assert docs.columns == names
        ids = collections.Counter(r["doc_id"] for r in after)
        if name == "language":
            assert set(ids) == {r["doc_id"] for r in before if any(map(str.isalpha, r["text"] or ""))}
        elif name == "near_duplicates":
            assert set(ids) == {d for d, c, _ in brute([(r["doc_id"], r["text"]) for r in before]) if d == c}
        elif name == "substrings":
            first, left = {}, {}
            for r in sorted(before, key=lambda r: r["doc_id"]):
                w = WORD.findall(r["text"])
                gone = set()
                for i in range(len(w) - 49):
                    if first.setdefault(tuple(w[i : i + 50]), r["doc_id"]) < r["doc_id"]:
                        gone |= set(range(i, i + 50))
                if len(gone) < len(w):
                    left[r["doc_id"]] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r["text"]
            assert left == {r["doc_id"]: r["text"] for r in after} and all(r["n_chars"] == len(r["text"]) or r["text"] in {b["text"] for b in before} for r in after)
        elif name == "mixture":
            size = collections.defaultdict(int)
            for r in before:
                size[r["source"]] += len(WORD.findall(r["text"]))
            taken = collections.defaultdict(int)
            for r in after:
                taken[r["source"]] += len(WORD.findall(r["text"]))
            most = max(len(WORD.findall(r["text"])) for r in before)
            assert max(ids.values()) <= 2 and all(abs(taken[s] - t) <= most for s, t in fill(dict(size)).items())
        else:
            tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            want = sorted((r["doc_id"], tool.encode(r["text"], add_special_tokens=False).ids) for r in before)
            assert want == sorted((r["doc_id"], r["ids"]) for r in after)
