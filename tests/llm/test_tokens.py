import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers

from activity_lake.llm import merge_dropout, packing, token_counts, token_files
from activity_lake.llm.tokens import Encoder
from activity_lake.session import new_path
from tests.llm.helpers import ODD, plain_hash, table

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CHARS = list("ab  .,\n\t'1é ñß—▁日本\x85ſİΣ́\r've!?<0xA>\x1c the ning")


def odd_texts(n=3000):
    rng = random.Random(1)
    return [t or "" for _, t in ODD] + ["".join(rng.choices(CHARS, k=rng.randint(0, 60))) for _ in range(n)]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_library(path):
    encoder, library = Encoder(path), Tokenizer.from_file(path)
    special = ["a<|endoftext|>b", "<|startoftext|><|endoftext|> x,", "<|ENDOFTEXT|>  <|endoftext|>\n\n<|end", "word <| word"]
    for text in odd_texts() + special:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, repr(text[:80])


def test_an_encoder_keeps_to_its_memory():
    encoder, library = Encoder(WORDS, kept=8), Tokenizer.from_file(WORDS)
    for text in odd_texts(300):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        # A chunk may bring in the word that it begins with.
        assert len(encoder.words) <= 9 and len(encoder.pieces) <= 8


@pytest.mark.parametrize("bits", [1, 7, 8, 15, 16, 17, 24, 31, 32])
def test_packing_of_ids_is_exact(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype("<u4")
    body = token_files.pack_ids(ids, bits)
    assert len(body) == -(-1003 * bits // 8)
    assert (token_files.unpack_ids(body, bits, 1003) == ids).all()
    shard = token_files.Shard(token_files.write_shard([5, None], [ids[:400], ids[400:]], bits, block_ids=64))
    for a, b in [(0, 1003), (0, 0), (63, 65), (64, 128), (700, 701), (1000, 1003)]:
        assert (shard.ids(a, b) == ids[a:b]).all()
    assert (shard.document(1) == ids[400:]).all()
    with pytest.raises(ValueError):
        token_files.write_shard([1], [np.array([1 << bits], "<u8")], bits) if bits < 32 else token_files.Shard(b"x" * 64)


def test_token_files_round_trip(spark):
    path = new_path(spark, "tokens")
    token_files.write_token_files(table(spark, ODD).repartition(3), path, BYTES, 2, shard_ids=1000, block_ids=64)
    read = token_files.read_token_files(spark, path).collect()
    got = sorted((r["start"], r["doc_id"], bytes(r["ids"])) for r in read)
    assert [r[1] for r in got] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d or 0))
    at = 0
    for start, doc, ids in got:
        assert start == at
        at += len(ids) // 4
        assert ids in [np.array(ids_of(BYTES, t) + [2], "<u4").tobytes() for d, t in ODD if d == doc]
    empty = new_path(spark, "tokens")
    token_files.write_token_files(table(spark, ODD).limit(0), empty, BYTES, 2)
    assert token_files.read_token_files(spark, empty).count() == 0


@pytest.mark.parametrize("capacity", [4096, 50])
def test_packed_documents(spark, capacity):
    rows = packing.pack_documents(table(spark, ODD), WORDS, 1, capacity).toPandas()
    pieces = []
    for doc, text in ODD:
        ids = ids_of(WORDS, text) + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4").tobytes()
            pieces.append((doc, k, at, len(part) // 4, crc32(part)))
    got = [
        (None if d != d else int(d), *map(int, rest)) for d, *rest in
        rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)]
    assert sorted(map(str, got)) == sorted(map(str, pieces))
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        assert (sequence["offset"] == sequence["length"].cumsum() - sequence["length"]).all()
        assert sequence["length"].sum() <= capacity


def test_packing_of_an_empty_table(spark):
    assert packing.pack_documents(table(spark, ODD).limit(0), WORDS, 1).count() == 0


def least_sequences(sizes, capacity):
    """The fewest sequences, by trying everything."""
    best = len(sizes)

    def place(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= rest[0] and rooms[i] not in rooms[:i]:
                place(rest[1:], rooms[:i] + [rooms[i] - rest[0]] + rooms[i + 1:])
        place(rest[1:], rooms + [capacity - rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best


def test_plans_are_exact_and_near_the_least():
    rng = random.Random(6)
    over = 0
    for _ in range(60):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        counts = {s: sizes.count(s) for s in sizes}
        plan = packing.plan_sequences(counts, 20)
        used = {}
        for copies, config in plan:
            assert sum(s * k for s, k in config.items()) <= 20
            for s, k in config.items():
                used[s] = used.get(s, 0) + copies * k
        assert used == counts
        over += sum(c for c, _ in plan) - (least_sequences(sizes, 20) if sizes else 0)
    assert 0 <= over <= 3
    counts = {s: rng.randint(1, 400) for s in range(1, 600)}
    plan = packing.plan_sequences(counts, 512 * 2)
    total = sum(s * n for s, n in counts.items())
    assert sum(c for c, _ in plan) <= 1.01 * -(-total // 1024)


def test_equal_lengths_are_split_and_ranked(spark):
    pieces = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.when(F.col("id") % 10 == 0, 7).otherwise(3).cast("long").alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    got = packing.ranked(pieces, rank_rows=100).groupBy("length").agg(
        F.sort_array(F.collect_list("rank")).alias("ranks")).collect()
    assert {r["length"]: r["ranks"] for r in got} == {7: list(range(500)), 3: list(range(4500))}


def test_counts_equal_the_tokenizer(spark):
    tokenizer = Tokenizer(models.Unigram(token_counts.vocabulary(PIECES), 0, True))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    counter = token_counts.counter(PIECES)
    for text in odd_texts():
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text[:80])
    docs = table(spark, ODD)
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in token_counts.count_tokens(docs, PIECES).collect())
    assert got == sorted((str(d), counter.count(t or "")) for d, t in ODD)
    assert token_counts.count_tokens(docs.limit(0), PIECES).count() == 0


def test_ties_take_the_piece_that_starts_first():
    pieces = [(f"<0x{b:02X}>", -9.0) for b in range(256)] + [
        ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("c", -2.0), ("ab", -2.0), ("abc", -4.0), ("▁ab", -3.0), ("bc", -3.0)]
    tokenizer = Tokenizer(models.Unigram(pieces, 0, True))
    counter = token_counts.Counter(pieces)
    rng = random.Random(8)
    for _ in range(2000):
        text = "".join(rng.choices("abcd▁", k=rng.randint(1, 12)))
        chunks = token_counts.RUN.findall(text)
        assert sum(counter[c] for c in chunks) == len(tokenizer.encode(text).ids), text


def test_merges_equal_the_library_and_decode():
    merges, library = merge_dropout.merges(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts()
    exact = merge_dropout.Encoder(merges, 0, 0.0, 4).encode([0] * len(texts), texts)
    for text, ids in zip(texts, exact):
        if "▁" not in text:
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text), repr(text[:80])
    lengths = []
    for dropout in (0.0, 0.1, 0.5, 1.0):
        ids = merge_dropout.Encoder(merges, 3, dropout, 4).encode(list(range(len(texts))), texts)
        assert [merges.decode(i) for i in ids] == texts
        lengths.append(sum(map(len, ids)))
    assert lengths == sorted(set(lengths))
    single = merge_dropout.Encoder(merges, 3, 1.0, 4).encode([1], ["the thing"])[0]
    assert len(single) // 4 == len(" the thing")


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_dropout_equals_a_plain_agenda(dropout):
    """The agenda of each chunk as a list of symbols, the same keyed hash, one merge or skip at a time."""
    merges, texts = merge_dropout.merges(PIECES), odd_texts(300) + ["internationalization of the thing"] * 20
    table = {int(p): (int(r), int(m)) for p, r, m in zip(merges.pairs, merges.ranks, merges.merged)}
    encoder = merge_dropout.Encoder(merges, 5, dropout)
    limit = min(int(dropout * 2**64), 2**64 - 1)

    def plain(chunk, key):
        symbols, skipped = [(k, int(merges.of_char[ord(c)])) for k, c in enumerate(chunk)], set()
        while True:
            agenda = []
            for (i, a), (j, b) in zip(symbols, symbols[1:]):
                found = table.get(a * (merges.unknown + 1) + b)
                if found and (i, a, j, b) not in skipped:
                    agenda.append((found[0], i, a, j, b, found[1]))
            if not agenda:
                break
            _, i, a, j, b, merged = min(agenda)
            if plain_hash(key ^ (plain_hash(i, j, merged) | 1)) < limit:
                skipped.add((i, a, j, b))
            else:
                at = symbols.index((i, a))
                symbols[at:at + 2] = [(i, merged)]
        out = []
        for i, s in symbols:
            out += [s] if s < len(merges.texts) else [merges.byte_ids[b] for b in chunk[i].encode()]
        return out

    got = encoder.encode(list(range(len(texts))), texts)
    for doc, (text, ids) in enumerate(zip(texts, got)):
        if len(text) > 2000:
            continue
        want = [i for place, chunk in enumerate(encoder.chunks(text)) for i in plain(chunk, plain_hash(5, doc, place))]
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


def test_groups_of_rows_are_bounded_by_their_bytes():
    texts = ["x" * n for n in (0, 5, merge_dropout.GROUP_BYTES, 3, merge_dropout.GROUP_BYTES * 2, 1, 1, 0)]
    batch = merge_dropout.pa.RecordBatch.from_pydict({"text": texts})
    groups = [g.column("text").to_pylist() for g in merge_dropout._groups(batch)]
    assert [t for g in groups for t in g] == texts and max(len(g) for g in groups) <= 4


def test_dropout_is_seeded_and_varies():
    merges, word = merge_dropout.merges(PIECES), "internationalization " * 40
    encode = lambda seed, doc: merge_dropout.Encoder(merges, seed, 0.2, 4).encode([doc], [word])[0]
    assert encode(1, 5) == encode(1, 5) and encode(1, 5) != encode(2, 5) and encode(1, 5) != encode(1, 6)


def test_every_occurrence_draws_for_itself():
    merges = merge_dropout.merges(PIECES)
    encoder = merge_dropout.Encoder(merges, 7, 0.2)
    text = " ".join(["internationalization", "thing", "x" * 60] * 300)
    for doc in (5, 6):
        keys = merge_dropout.keyed(7, doc, np.arange(900))
        chunks = encoder.chunks(text)
        alone = [merges.segment([c], keys[i:i + 1], 0.2)[0] for i, c in enumerate(chunks)]
        assert encoder.encode([doc], [text])[0] == b"".join(alone)
        assert len(set(alone[::3])) > 20 and len(set(alone[1::3])) > 4
    assert encoder.encode([5, None, 6], ["", "", text])[2] == b"".join(alone)


def test_dropout_rows(spark):
    docs = table(spark, ODD)
    encoded = merge_dropout.encode_with_dropout(docs, PIECES, seed=3)
    got = merge_dropout.decode_ids(encoded, PIECES).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(d), t or "") for d, t in ODD)
    assert merge_dropout.encode_with_dropout(docs.limit(0), PIECES).count() == 0
