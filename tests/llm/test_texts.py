"""Pieces, fingerprints, files of ids and token counts against the libraries and brute force."""

import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from cases import documents, odd_rows
from pyspark.sql import functions as F

from tidemark.llm import idcoder, phrases, pieces, tokencache
from tidemark.llm.common import slices

ODD = [
    "", " ", "  a  b ", "a\n b", "x <|endoftext|> y", "<|ENDOFTEXT|>", "a<|startoftext|>b", "it's 12 34  b\t",
    "▁▁x ▁", "<s> </s> <unk> <0x41>", "a" * 300, " " * 9, "𝄞𝄞 é 漢字", "a\u3000b\x85c\x1cd",
]


def texts():
    rng = random.Random(2)
    letters = "aethion é.\nß漢☃▁ '1,"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 120))) for _ in range(150)]


def test_pieces_equal_the_library_and_decode(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [*enumerate(texts()), (None, None), (7, "a repeated id")]
    encoded = pieces.encoded(documents(spark, rows), path)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in encoded.collect())
    assert got == sorted((i is None, i or 0, library.encode(t or "")) for i, t in rows)
    for r in pieces.decoded(encoded, path).where("doc_id is not null and doc_id <> 7").collect():
        assert r.n_pieces == len(r.ids)
        # The mark of spaces can't be told from a space afterwards.
        assert r.text == library.decode(r.ids) == dict(rows)[r.doc_id].replace("▁", " ")
    assert pieces.encoded(documents(spark, rows).limit(0), path).count() == 0


def test_many_lists_are_spelled_at_once():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, speller = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Speller(path)
    marks = [speller.bytes[b] for b in "▁é".encode()]
    lists = [model.encode("to be  or not "), [], None, [speller.unknown, 700], marks, marks[:4], [0, 1, 2, 500]]
    lists += [[marks[3], 700, marks[4]], [*marks, 700], model.encode("\u2603 ▁ x")]
    found = pa.array(lists, pa.list_(pa.int32()))
    assert speller.decode_all(found).to_pylist() == [speller.decode(ids or []) for ids in lists]
    assert speller.decode_all(found.slice(3, 4)).to_pylist() == [speller.decode(ids) for ids in lists[3:7]]
    with pytest.raises(Exception):
        speller.decode_all(pa.array([[model.get_piece_size()]], pa.list_(pa.int32())))


def test_pieces_spell_broken_bytes_like_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, lattice = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Lattice(path)
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(300) for _ in range(10)]
        assert lattice.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("parts", [1, 7])
def test_edited_fingerprints(spark, parts):
    rng = random.Random(parts)
    rows = [(i * 5, "".join(rng.choice("abcd é") for _ in range(rng.randrange(400)))) for i in range(60)]
    rows += [(11, None), (12, ""), (13, "x")]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in phrases.edited_fingerprints(documents(spark, rows), parts).collect()}
    ordered = sorted(rows, reverse=True)

    def mark(text):
        return phrases.fingerprint(phrases.Parser().read(text))

    for (i, text), (_, following) in zip(ordered, [*ordered[1:], ordered[0]]):
        text, following = text or "", following or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (mark(text), mark(edited))
        assert r.near_edited == phrases.likeness(mark(text), mark(edited))
        assert r.near_next == phrases.likeness(mark(text), mark(following))


def test_fingerprints_are_of_whole_texts_and_estimate_shares():
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    whole = phrases.Parser().read(text)
    parted = phrases.Parser().read(text[:7000]).fork().read(text[7000:])
    assert whole.phrases == parted.phrases
    other = phrases.Parser().read(text[:14_000] + text[:6000][::-1])
    share = len(whole.phrases & other.phrases) / len(whole.phrases | other.phrases)
    assert abs(phrases.likeness(*map(phrases.fingerprint, (whole, other))) - share) < 0.25


@pytest.mark.parametrize("extra", ("_part", "content"))
def test_odd_rows(spark, extra):
    frame, n = documents(spark, odd_rows(), extra), len(odd_rows())
    for parts in (1, 4):
        assert phrases.edited_fingerprints(frame, parts).count() == n
    got = {r.doc_id: r.fingerprint for r in phrases.fingerprints(frame).collect()}
    assert got[1] == got[2] and got[3] == got[4] and got[1] != got[6]
    assert phrases.edited_fingerprints(frame.limit(0), 4).count() == 0
    assert phrases.edited_fingerprints(frame.where("doc_id = 8"), 4).count() == 1
    assert phrases.edited_fingerprints(frame.where("doc_id is null"), 4).count() == 2


def test_ids_come_back_from_files(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    monkeypatch.setattr(idcoder, "SEGMENT_IDS", 3000)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts())] + [(5000, None), (5001, "long text " * 3000)]
    frame = documents(spark, rows)
    idcoder.write_ids(frame, path, 2, f"{tmp_path}/ids")
    got = sorted(idcoder.read_ids(spark, f"{tmp_path}/ids").collect())
    sums = {r.doc_id: r.ids_crc32 for r in idcoder.read_checksums(spark, f"{tmp_path}/ids").collect()}
    start = 0
    for r, (i, t) in zip(got, sorted(rows)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, start, len(ids), ids)
        assert sums[i] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(rows)
    idcoder.write_ids(documents(spark, odd_rows(), "start"), path, 2, f"{tmp_path}/odd")
    assert idcoder.read_ids(spark, f"{tmp_path}/odd").count() == len(odd_rows())
    idcoder.write_ids(frame.limit(0), path, 2, f"{tmp_path}/none")
    assert idcoder.read_ids(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("most", [1, 16, 65536])
def test_coded_blocks(most):
    rng = np.random.default_rng(most)
    ids = rng.integers(0, most, 9000).astype(np.uint32)
    lengths = np.array([4096, 1, 4096, 807])
    blocks = idcoder.encode_blocks(ids, lengths, 4)
    assert np.array_equal(np.concatenate(idcoder.decode_blocks(blocks, lengths, 4)), ids)
    # A block depends on itself alone.
    again = idcoder.decode_blocks(blocks[2:3], lengths[2:3], 4)
    assert np.array_equal(again[0], ids[4097:8193])


def test_a_model_makes_blocks_smaller():
    rng = np.random.default_rng(1)
    ids = np.tile(rng.integers(0, 50_000, 50).astype(np.uint32), 80)
    blocks = idcoder.encode_blocks(ids, np.array([4000]), 4)
    assert len(blocks[0]) < len(ids)


def test_a_damaged_block_is_an_error(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    idcoder.write_ids(documents(spark, [(1, "some text")]), path, 2, f"{tmp_path}/ids")
    segments = spark.read.schema(idcoder.SEGMENT_SCHEMA).parquet(f"{tmp_path}/ids")
    segments.withColumn("checksums", F.array(F.lit(1).cast("long"))).write.parquet(f"{tmp_path}/bad")
    with pytest.raises(Exception, match="damaged"):
        idcoder.read_ids(spark, f"{tmp_path}/bad").collect()


def test_token_counts_and_their_cache(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = [*enumerate(texts()), *((i + 1000, t) for i, t in enumerate(ODD)), (None, None), (3, "again")]
    frame, cache = documents(spark, rows, "content"), f"{tmp_path}/cache"

    def expected(rows):
        return sorted(
            (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False)), i or -1)
            for i, t in rows
        )

    def counted(frame):
        return sorted((r.n_bytes, r.n_tokens, r.doc_id or -1) for r in tokencache.token_counts(frame, path, cache).collect())

    assert counted(frame) == expected(rows)
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == stored.select("content").distinct().count()
    # Nothing is encoded that is known: what the cache says is taken.
    assert counted(frame) == expected(rows) and spark.read.parquet(cache).count() == n
    more = [*rows, (77_777, "a new text of some words")]
    assert counted(documents(spark, more)) == expected(more)
    assert spark.read.parquet(cache).count() == n + 1
    assert tokencache.token_counts(frame.limit(0), path, cache).count() == 0
    odd = documents(spark, odd_rows())
    assert counted(odd) == expected(odd_rows())
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() > n + 1
    # A second time nothing is missed, and no file is added.
    files = len(stored.inputFiles())
    assert counted(odd) == expected(odd_rows()) and len(spark.read.parquet(cache).inputFiles()) == files


def test_repeated_rows_are_encoded_once(spark, tmp_path):
    rows = [(1, "the same text in every row")] * 3 + [(2, "the same text in every row")]
    cache = f"{tmp_path}/cache"
    assert tokencache.token_counts(documents(spark, rows), public_tokenizers.path("word_bpe_49k.json"), cache).count() == 4
    assert spark.read.parquet(cache).count() == 1


def test_pieces_of_odd_rows_and_long_texts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    long = " ".join(f"word{i} {i * 7919}" for i in range(200_000))
    rows = [*odd_rows(), (99, long), (100, "x" * 3_000)]
    frame = documents(spark, rows, "ids")
    encoded = pieces.encoded(frame, path)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=key)
    assert got == sorted(((i, library.encode(t or "")) for i, t in rows), key=key)
    named = encoded.selectExpr("doc_id", "n_pieces", "ids", "'t' as text", "1 as piece")
    spelled = {r.doc_id: r for r in pieces.decoded(named, path).collect()}
    assert spelled[99].text == long and spelled[99].piece == 1 and spelled[3].text == ""


def test_what_a_worker_keeps_outlives_a_task(spark):
    from tidemark.llm.common import of_worker

    def met(batches):
        kept = of_worker("a test")
        for batch in batches:
            kept["tasks"] = kept.get("tasks", 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([kept["tasks"]])], ["n"])

    counts = [spark.range(1).coalesce(1).mapInArrow(met, "n long").collect()[0]["n"] for _ in range(12)]
    # Workers are reused, though not always the same one.
    assert max(counts) > 1


def test_a_worker_lets_go_of_what_another_step_kept(spark):
    from tidemark.llm.common import map_batches, of_worker

    of_worker("a step")["large"] = 1
    assert of_worker("a step") == {"large": 1}
    of_worker("the next step")
    assert of_worker("a step") == {}

    def keeping(batches):
        of_worker("a step")["large"] = 1
        yield from batches

    def looking(batch):
        # What there is under any name when a step begins that keeps nothing.
        kept = vars(sys.modules["tidemark_of_worker"])
        names = [n for n, v in kept.items() if isinstance(v, dict) and n != "kept" and not n.startswith("__")]
        return {"n": pa.array([len(names) + sum(map(len, kept.get("kept", {}).values()))] * batch.num_rows)}

    for _ in range(3):
        spark.range(0, 320, 1, 32).mapInArrow(keeping, "id long").collect()
        found = map_batches(spark.range(0, 320, 1, 32), "n long", looking).collect()
        assert {r.n for r in found} == {0}


@pytest.mark.parametrize("most", [1, 5, 10_000])
def test_slices_are_bounded_and_whole(most):
    batch = pa.RecordBatch.from_arrays([pa.array([b"ab", None, b"", b"abcdefg", b"a", b"b"])], ["text"])
    parts = list(slices(batch, "text", most))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    for p in parts:
        sizes = [len(v or b"") for v in p.column("text").to_pylist()]
        assert sum(sizes) <= most or len([s for s in sizes if s]) == 1
