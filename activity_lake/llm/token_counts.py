"""Token counts by a count-only Viterbi search over a unigram vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from activity_lake.llm.common import id_and_text

# The mark that stands for a space, what an unknown character costs below the least score, and the
# name of a piece that stands for one byte.
SPACE = "▁"
UNKNOWN_COST = 10.0
BYTE_PIECE = "<0x%02X>"
# Cut pieces whose count is remembered per worker; the memory forgets all when it is full.
CHUNKS_KEPT = 1_000_000

RUN = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a SentencePiece model file with their scores, taken as the scores of a unigram model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())]


class Counter(dict):
    """Number of tokens of a chunk, searched once while remembered.

    The search keeps the best score and its count for each end. An Aho-Corasick automaton names the pieces that end
    there. A better score wins; of equal scores the piece that starts first, as the tokenizer, which goes through the
    starts in order, replaces a path only by a strictly better one. A character that is no piece costs the least score
    less ``UNKNOWN_COST`` and counts as its bytes.

    A chunk is a run of space marks with the characters after it. As no piece has a space mark behind another
    character, a best path of the text is made of best paths of its chunks.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        if any(SPACE in p.lstrip(SPACE) for p, _ in pieces):
            raise ValueError("a piece has a space mark behind another character")
        names = {p for p, _ in pieces}
        if any(BYTE_PIECE % b not in names for b in range(256)):
            raise ValueError("the vocabulary has no byte pieces")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in names if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_COST

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CHUNKS_KEPT:
            self.clear()
        count = self[chunk] = self.search(chunk)
        return count

    def search(self, chunk: str) -> int:
        ends: list[list[tuple[int, float]]] = [[] for _ in chunk]
        for end, found in self.automaton.iter(chunk):
            ends[end].append(found)
        scores, counts = [0.0], [0]
        for end, (char, found) in enumerate(zip(chunk, ends), 1):
            best, count = None, 0
            # The automaton names the longest piece first, which starts first.
            for size, score in found:
                if scores[end - size] is not None and (best is None or scores[end - size] + score > best):
                    best, count = scores[end - size] + score, counts[end - size] + 1
            if char not in self.single and scores[-1] is not None and (best is None or scores[-1] + self.unknown > best):
                best, count = scores[-1] + self.unknown, counts[-1] + len(char.encode())
            scores.append(best)
            counts.append(count)
        return counts[-1]

    def count(self, text: str) -> int:
        """Tokens of a text, which is read with a space before it."""
        if not text:
            return 0
        if text[0] != " " and "  " not in text and SPACE not in text:
            first, *rest = text.split(" ")
            return self[SPACE + first] + sum([self[SPACE + c] for c in rest])
        return sum([self[c] for c in RUN.findall(SPACE + text.replace(" ", SPACE))])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def _count_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            n = np.fromiter((count(t.as_py()) for t in batch.column("text")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n)], ["doc_id", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of each row's whole text, without making the tokens.

    Null and empty texts have none. Rows are counted one by one: repeated rows alike, null ids as they are; an empty
    table gives an empty result; other columns are not read.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_count_rows(model), "doc_id long, n_tokens long")
