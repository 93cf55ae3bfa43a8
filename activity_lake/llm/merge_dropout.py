"""SentencePiece merges with seeded dropout, and decoding."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import id_and_text

# The mark that stands for a space, and the name of a piece that stands for one byte.
SPACE = "▁"
BYTE_PIECE = "<0x%02X>"
# Chunks, and outcomes of draws, remembered per worker; longest chunk that is merged together with others.
CHUNKS_KEPT = 150_000
NODES_KEPT = 2_000_000
LONG = 48
# Marks, by hash, of chunks that came once.
MET = 1 << 22
# Chunks that are merged together.
TOGETHER = 1 << 15
# Text that is encoded at a time.
GROUP_BYTES = 2_000_000
NONE = np.iinfo(np.int64).max

RUN = re.compile(" +[^ ]*|[^ ]+")


def keyed(*parts: np.ndarray | int) -> np.ndarray:
    """64-bit hash of numbers, the same on every machine."""
    total = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for part in parts:
            x = (total ^ np.asarray(part).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            total = x ^ (x >> np.uint64(32))
    return total


class Merges:
    """Symbols and merges of a SentencePiece model of the merge type with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        plain = [i for i in range(size) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        names = {model.id_to_piece(i): i for i in plain}
        self.byte_ids = [model.piece_to_id(BYTE_PIECE % b) for b in range(256)]
        self.texts = [b""] * size
        for name, i in names.items():
            self.texts[i] = name.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.texts[i] = bytes([b])
        # Characters that only occur within pieces are symbols too, behind the ids.
        within = sorted({c for name in names for c in name} - set(names))
        symbols = {**names, **{c: size + k for k, c in enumerate(within)}}
        self.lone = {size + k: c for k, c in enumerate(within)}
        self.unknown = size + len(within)
        self.of_char = np.full(0x110000, self.unknown, np.int64)
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        # Spaces are read as the mark; a mark in a text is an unknown character, so that it is not decoded as a space.
        self.of_char[ord(" ")], self.of_char[ord(SPACE)] = self.of_char[ord(SPACE)], self.unknown
        ranks = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        merges = sorted(
            (symbols[name[:k]] * (self.unknown + 1) + symbols[name[k:]], ranks[model.get_score(i)], i)
            for name, i in names.items() for k in range(1, len(name))
            if name[:k] in symbols and name[k:] in symbols)
        self.pairs, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*merges))
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("a piece has a space mark behind another character")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (the lowest merges first) and result of each pair; no merge has rank ``NONE``."""
        key = left * (self.unknown + 1) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def segment(self, chunks: list[str], keys: np.ndarray, dropout: float, trace: list | None = None) -> list[bytes]:
        """Ids of each chunk, as little-endian unsigned 32-bit bytes; ``trace`` takes (chunk, draw, skipped) per round.

        Each round takes the first merge of every chunk's agenda: the lowest rank, then the leftmost. It is skipped,
        and leaves the agenda, when the hash of the chunk's key, its two ends and its result is below ``dropout``.
        Else the two symbols become one and the pairs beside it are new candidates.
        """
        chars = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.array([len(c) for c in chunks])
        ends = np.cumsum(lengths)
        starts, owner = ends - lengths, np.repeat(np.arange(len(chunks)), lengths)
        n = len(chars)
        symbol = self.of_char[chars]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = before[starts] = -1
        rank, result = np.full(n, NONE), np.zeros(n, np.int64)
        inner = np.flatnonzero(after >= 0)
        rank[inner], result[inner] = self.look_up(symbol[inner], symbol[inner + 1])
        alive = np.ones(n, bool)
        limit = np.uint64(min(int(dropout * 2**64), 2**64 - 1))
        seat = np.arange(n)
        while True:
            open_ = np.flatnonzero(rank[seat] != NONE)
            if not len(open_):
                break
            # Only chunks with something on their agenda stay.
            busy = np.zeros(len(chunks), bool)
            busy[owner[seat[open_]]] = True
            seat = seat[busy[owner[seat]] & alive[seat]]
            new = np.flatnonzero(np.r_[True, owner[seat[1:]] != owner[seat[:-1]]])
            least = np.repeat(np.minimum.reduceat(rank[seat], new), np.diff(np.r_[new, len(seat)]))
            at = seat[rank[seat] == least]
            at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]
            if dropout:
                base = starts[owner[at]]
                # Never 0, which marks a leaf.
                draw = keyed(at - base, after[at] - base, result[at]) | np.uint64(1)
                skip = keyed(keys[owner[at]] ^ draw) < limit
                if trace is not None:
                    trace.append((owner[at], draw, skip.astype(np.int64)))
                rank[at[skip]] = NONE
                at = at[~skip]
                if not len(at):
                    continue
            gone = after[at]
            symbol[at], after[at] = result[at], after[gone]
            alive[gone], rank[gone] = False, NONE
            behind = after[at] >= 0
            before[after[at[behind]]] = at[behind]
            rank[at[~behind]] = NONE
            left = np.r_[at[behind], before[at[before[at] >= 0]]]
            rank[left], result[left] = self.look_up(symbol[left], symbol[after[left]])
        return self._as_bytes(symbol, chars, alive, owner, len(chunks))

    def _as_bytes(self, symbol, chars, alive, owner, n_chunks: int) -> list[bytes]:
        kept = np.flatnonzero(alive)
        ids, of = symbol[kept], owner[kept]
        odd = np.flatnonzero(ids >= len(self.texts))
        if len(odd):
            spelled = [
                np.array([self.byte_ids[b] for b in chr(chars[kept[i]]).encode("utf-8", "surrogatepass")]) for i in odd]
            counts = np.ones(len(ids), np.int64)
            counts[odd] = [len(s) for s in spelled]
            first = np.cumsum(counts) - counts
            wide = np.repeat(ids, counts)
            for i, s in zip(first[odd], spelled):
                wide[i:i + len(s)] = s
            ids, of = wide, np.repeat(of, counts)
        data = ids.astype("<u4").tobytes()
        cuts = np.searchsorted(of, np.arange(n_chunks + 1)) * 4
        return [data[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def decode(self, ids: bytes) -> str:
        """The text that was encoded; the space put before it is taken off."""
        text = b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text[1:].decode()


class Encoder:
    """Encodes texts; remembers, per chunk, what follows from each outcome of the draws.

    The agenda of a chunk is a tree: a node is a merge to draw for, its children are what comes up when the merge is
    done or skipped, a leaf is a segmentation. Every occurrence draws anew, by its own key, on its way down; only nodes
    that no occurrence has reached are worked out. A chunk has no tree before it comes again, as most come once; chunks
    longer than ``LONG`` never have one.
    """

    def __init__(self, merges: Merges, seed: int, dropout: float, nodes_kept: int = NODES_KEPT):
        self.merges, self.seed, self.dropout, self.nodes_kept = merges, seed, dropout, nodes_kept
        self.limit = np.uint64(min(int(dropout * 2**64), 2**64 - 1))
        self.forget()

    def forget(self) -> None:
        self.roots: dict[str, int] = {}
        self.size = 0
        self.met = np.zeros(MET, bool)
        # Draw of a node (0 at a leaf), and its children when the merge is done and skipped (-1: not known).
        self.draw, self.after = np.zeros(1 << 16, np.uint64), np.full((1 << 16, 2), -1, np.int64)
        self.ids: list[bytes | None] = []

    def chunks(self, text: str) -> list[str]:
        """A text with a space before it, cut before each run of spaces, where no merge reaches across."""
        if not text:
            return []
        if text[0] != " " and "  " not in text:
            return [" " + c for c in text.split(" ")] if text[-1] != " " else RUN.findall(" " + text)
        return RUN.findall(" " + text)

    def encode(self, docs: list[int | None], texts: list[str]) -> list[bytes]:
        if self.size >= self.nodes_kept or len(self.roots) >= CHUNKS_KEPT:
            self.forget()
        cut = [self.chunks(t) for t in texts]
        flat = [c for chunks in cut for c in chunks]
        if not flat:
            return [b""] * len(texts)
        counts = [len(c) for c in cut]
        places = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        owners = np.repeat(np.array([d or 0 for d in docs], np.int64), counts)
        keys = keyed(self.seed, owners, places)
        found = self._encode(flat, keys)
        ends = np.cumsum(counts).tolist()
        return [b"".join(found[i:j]) for i, j in zip([0, *ends[:-1]], ends)]

    def _encode(self, flat: list[str], keys: np.ndarray) -> list[bytes]:
        at = np.array([self.roots.get(c, -1) for c in flat], np.int64)
        self._walk(at, keys, np.flatnonzero(at >= 0))
        open_ = np.flatnonzero(at < -1)
        long, once, again = self._unknown(flat, np.flatnonzero(at == -1).tolist())
        rest = np.r_[open_, again]
        # Once what the first occurrence of each outcome needs is known, others can walk on.
        while len(rest):
            new, open_ = rest[at[rest] == -1], rest[at[rest] < -1]
            first: dict[str, int] = {}
            for i in new.tolist():
                first.setdefault(flat[i], i)
            _, one_of_each = np.unique(at[open_], return_index=True)
            self._learn([*first.values(), *open_[one_of_each].tolist()], flat, keys)
            at[new] = [self.roots[flat[i]] for i in new.tolist()]
            way = -2 - at[open_]
            at[open_] = self.after[way // 2, way % 2]
            self._walk(at, keys, rest)
            rest = rest[at[rest] < 0]
        out = list(map(self.ids.__getitem__, at.tolist())) if self.ids else [b""] * len(flat)
        for begin in range(0, len(once), TOGETHER):
            part = once[begin:begin + TOGETHER]
            for i, ids in zip(part, self.merges.segment([flat[i] for i in part], keys[part], self.dropout)):
                out[i] = ids
        for i in long:
            out[i] = self.merges.segment([flat[i]], keys[i:i + 1], self.dropout)[0]
        return out

    def _unknown(self, flat: list[str], unknown: list[int]) -> tuple[list[int], list[int], np.ndarray]:
        """Occurrences without a tree: of long chunks, of chunks met for the first and only time, and the others."""
        times = Counter([flat[i] for i in unknown])
        long, once, others = [], [], []
        for i in unknown:
            chunk = flat[i]
            if len(chunk) > LONG:
                long.append(i)
            elif times[chunk] > 1 or self.met[mark := hash(chunk) % MET]:
                others.append(i)
            else:
                self.met[mark] = True
                once.append(i)
        return long, once, np.array(others, np.int64)

    def _walk(self, at: np.ndarray, keys: np.ndarray, going: np.ndarray) -> None:
        """Moves the nodes ``at[going]`` to leaves; where a child is not known, to -2 less the node's and draw's number."""
        while len(going):
            node = at[going]
            draw = self.draw[node]
            inner = draw != 0
            going, node, draw = going[inner], node[inner], draw[inner]
            skipped = (keyed(keys[going] ^ draw) < self.limit).astype(np.int64)
            child = self.after[node, skipped]
            at[going] = np.where(child >= 0, child, -2 - 2 * node - skipped)
            going = going[child >= 0]

    def _learn(self, which: list[int], flat: list[str], keys: np.ndarray) -> None:
        """Adds the ways of these occurrences to the trees."""
        for begin in range(0, len(which), TOGETHER):
            part = which[begin:begin + TOGETHER]
            trace: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            ids = self.merges.segment([flat[i] for i in part], keys[part], self.dropout, trace)
            steps = sum(len(owner) for owner, _, _ in trace) + len(part)
            while self.size + steps > len(self.draw):
                self.draw = np.r_[self.draw, np.zeros_like(self.draw)]
                self.after = np.r_[self.after, np.full_like(self.after, -1)]
            # No two of these occurrences take the same unknown way, so their new nodes are their own.
            for i in part:
                if flat[i] not in self.roots:
                    self.roots[flat[i]] = self.size
                    self.size += 1
            node = np.array([self.roots[flat[i]] for i in part], np.int64)
            for owner, draw, skip in trace:
                here = node[owner]
                self.draw[here] = draw
                child = self.after[here, skip]
                unknown = np.flatnonzero(child < 0)
                child[unknown] = np.arange(self.size, self.size + len(unknown))
                self.after[here[unknown], skip[unknown]] = child[unknown]
                self.size += len(unknown)
                node[owner] = child
            self.ids.extend([None] * (self.size - len(self.ids)))
            for leaf, found in zip(node.tolist(), ids):
                self.ids[leaf] = found


_merges: dict[str, Merges] = {}


def merges(path: str) -> Merges:
    if path not in _merges:
        _merges[path] = Merges(path)
    return _merges[path]


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about ``GROUP_BYTES`` of text together, so that memory is bounded whatever their lengths."""
    before = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)) // GROUP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def _encode_rows(path: str, seed: int, dropout: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges(path), seed, dropout)
        for batch in batches:
            for part in _groups(batch):
                ids = encoder.encode(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "n_tokens", "ids"])

    return run


def encode_with_dropout(
    docs: DataFrame, model: str, seed: int = 0, dropout: float = 0.1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row's whole text; ids are little-endian unsigned 32-bit bytes.

    With ``dropout`` 0 these are the model's own merges. Else each candidate merge is skipped with that probability, by
    a hash of the seed, the document, the place of the word in it and the merge, so that every occurrence draws for
    itself. The same seed gives the same ids. Null and empty texts have no ids. Rows are encoded one by one;
    a null id draws like 0; other columns are not read.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _encode_rows(model, seed, dropout), "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (doc_id, ids) as (doc_id, ids, text), exactly the texts that were encoded.

    Null and empty ids are an empty text; rows are decoded one by one; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = merges(model).decode
        for batch in batches:
            texts = [decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, ids binary, text string")
