"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic programming
keeps, for each position, the best score and how many tokens it takes, and nothing to go back by. Ties
fall as in the tokenizers library's Unigram model: a later candidate has to be strictly better, and
candidates come in order of where they start, so the longest piece wins. A character that is no piece
itself can also be unknown, for 10 below the least score. Unknown characters in a row count as their UTF-8
byte pieces where the file has these pieces (byte fallback), else as one token. Byte and control pieces are
never read from the text itself.

Spaces become the word mark first. No piece has a mark after another character (checked), so texts
fall into words, whose scores add up. With whole-number scores (as in the file the query uses) sums are
exact, so words and whole texts give equal ties: then each batch of texts counts its distinct words once,
and a worker remembers up to REMEMBERED words, by the words themselves. With other scores a sum's
rounding depends on what stands before, so whole texts are counted from their start, as the library does.

Edge cases: null and empty text count 0; other columns pass through, but for one with the output's name,
which it replaces; texts of any length are counted whole; repeated rows count alike; an empty table gives
an empty table.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinveil.llm._text import arrow_map, replaced

MARK = "▁"
REMEMBERED = 500_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Unigram:
    def __init__(self, pieces: list[tuple[str, float]], unk_id: int, fallback: frozenset[int] = frozenset()):
        """fallback: the bytes that have pieces."""
        if MARK not in dict(pieces) or any(MARK in p.lstrip(MARK) for p, _ in pieces):
            raise ValueError("the word mark has to be a piece, and to start every piece it is in")
        self.floor = min(s for _, s in pieces) - 10.0
        self.automaton = ahocorasick.Automaton()
        for i, (p, s) in enumerate(pieces):
            if p:
                self.automaton.add_word(p, (len(p), s, i == unk_id))
        self.automaton.make_automaton()
        self.known: dict[str, int] = {}
        self.whole = all(float(s).is_integer() for _, s in pieces)
        self.unk, self.fallback = pieces[unk_id][0], fallback

    def unknown(self, run: str) -> int:
        """Tokens of unknown characters in a row. The unknown piece itself, written in a text, is one."""
        raw = run.encode("utf-8", "surrogatepass")
        return len(raw) if run != self.unk and self.fallback.issuperset(raw) else 1

    def count(self, word: str) -> int:
        """Tokens of the best path of one text."""
        ending: list = [()] * len(word)
        for end, found in self.automaton.iter(word):
            ending[end] = (*ending[end], found)
        # A position within unknown characters has where these begin, and gets its tokens once a path needs them.
        best, tokens, begin, floor = [0.0], [0], [-1], self.floor

        def at(e: int) -> int:
            if tokens[e] < 0:
                tokens[e] = tokens[begin[e]] + self.unknown(word[begin[e] : e])
            return tokens[e]

        for e, found in enumerate(ending):
            top, start, odd, single = -np.inf, e, False, False
            for size, score, unk in sorted(found, reverse=True) if len(found) > 1 else found:
                s = e + 1 - size
                single |= size == 1
                if best[s] + score > top:
                    top, start, odd = best[s] + score, s, unk
            if not single and best[e] + floor > top:
                top, start, odd = best[e] + floor, e, True
            best.append(top)
            if odd:
                tokens.append(-1), begin.append(start if begin[start] < 0 else begin[start])
            else:
                tokens.append((tokens[start] if begin[start] < 0 else at(start)) + 1), begin.append(-1)
        return at(len(word))

    def counts(self, texts: list[str]) -> np.ndarray:
        return np.array([self._words(t.replace(" ", MARK)) for t in texts], np.int64)

    def _words(self, text: str) -> int:
        if not self.whole:
            return self.count(text)
        known, total = self.known, 0
        for m in _WORD.finditer(text):
            word = m[0]
            n = known.get(word)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = self.count(word)
                if len(word) < 64:  # long words are rare, and would fill the memory
                    known[word] = n
            total += n
        return total


def pieces(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces and scores of a sentencepiece file without control and byte pieces, and where unknown is."""
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(tool.get_piece_size()) if not tool.is_control(i) and not tool.is_byte(i)]
    return [(tool.id_to_piece(i), tool.get_score(i)) for i in ids], ids.index(tool.unk_id())


def byte_pieces(path: str) -> frozenset[int]:
    """The bytes that have a piece `<0xNN>` in a sentencepiece file."""
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    return frozenset(int(tool.id_to_piece(i)[3:-1], 16) for i in range(tool.get_piece_size()) if tool.is_byte(i))


@lru_cache(2)
def unigram(path: str) -> Unigram:
    return Unigram(*pieces(path), byte_pieces(path))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each text."""
    names = replaced(docs.columns, (out,))
    source = docs.select(*names, F.col(text_col).alias("__tc_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.LongType())])

    def run(batches):
        for batch in batches:
            n = unigram(path).counts([t.as_py() or "" for t in batch.column(len(names))])
            yield pa.record_batch([*batch.columns[:-1], pa.array(n)], names=schema.names)

    return arrow_map(source, run, schema)


def op10_token_count(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
        public_tokenizers.path("piece_bpe_32k.model"),
    ).drop("text")
