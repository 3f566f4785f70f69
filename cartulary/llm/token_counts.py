"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces in a word, and dynamic
programming carries the best score and the piece count to every position; no piece
list is made.  The rules are those of the public Unigram tokenizer with a metaspace
pre-tokenizer and byte fallback: a space starts a new word and becomes its first
character, a character without a piece of its own may be unknown at the least score
less 10 and counts as its UTF-8 bytes, and of equal scores at a position the piece
that starts earliest wins.  Scores are sums of doubles per word.

The vocabulary file's path is a parameter and must be readable on the executors.

Defined cases: null and empty texts have no tokens and the score 0; very long words
are counted as they are; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartulary.llm.shared import bounded_batches

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 300_000


class Counter(dict):
    """Word without its space mark to (pieces, score); forgets all words when it holds ``CACHED_WORDS``."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self.viterbi(SPACE + word)
        if len(word) <= 64:
            self[word] = found
        return found

    def viterbi(self, s: str) -> tuple[int, float]:
        """Piece count and score of the best segmentation."""
        score, count = [0.0] * (len(s) + 1), [0] * (len(s) + 1)
        done = 0  # positions up to here are final

        def unknown(e: int, reached: bool) -> None:
            new = score[e - 1] + self.unknown
            if not reached or new > score[e]:
                score[e], count[e] = new, count[e - 1] + len(s[e - 1].encode("utf-8", "surrogatepass"))

        single = reached = False
        at = 0
        for last, (length, worth) in self.automaton.iter(s):  # by end, at one end the longest piece first
            end = last + 1
            if end != at:
                if at and not single:
                    unknown(at, reached)
                for e in range(at + 1 if at else 1, end):
                    unknown(e, False)
                at, single, reached = end, False, False
            new = score[end - length] + worth
            if not reached or new > score[end]:
                score[end], count[end], reached = new, count[end - length] + 1, True
            single = single or length == 1
        if at and not single:
            unknown(at, reached)
        for e in range(at + 1, len(s) + 1):
            unknown(e, False)
        return count[-1], score[-1]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        words = text.replace(SPACE, " ").split(" ")
        if not words[0]:
            del words[0]
        pairs = [self[w] for w in words]
        return sum(c for c, _ in pairs), sum(x for _, x in pairs)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Counter:
    """Pieces and scores of a sentencepiece model file, one counter per worker process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Counter([(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())])


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per document row: doc_id, n_tokens, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for b in batches:
            pairs = [counter.text(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([c for c, _ in pairs], pa.int64()), pa.array([x for _, x in pairs], pa.float64())], ["doc_id", "n_tokens", "score"]
            )

    bounded_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, score double")
