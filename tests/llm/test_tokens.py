import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm.packing import pack, packed_documents, token_pieces, vector_best_fit
from lodestone.llm.token_io import (BLOCK_IDS, TokenFile, TokenFileWriter, bits_for, pack_bits, tokens_round_trip,
                                    unpack_bits)
from lodestone.llm.tokens import TextEncoder, default_path, encoder


def whole(text):
    """The ids of the library on the whole text."""
    return encoder(default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t 　ab'sT1.,é😀\x1c\x85<|endoftext|>")), max_size=40))
def test_ids_equal_those_of_the_whole_text(text):
    assert np.frombuffer(encoder(default_path()).ids(text), dtype="<u4").tolist() == whole(text)


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    data = pack_bits(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (unpack_bits(data, 1001, bits) == ids).all()


def test_minimum_bits():
    assert [bits_for(n) for n in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_file_random_access(tmp_path):
    w, rng = TokenFileWriter(17), np.random.default_rng(2)
    docs = [rng.integers(0, 1 << 17, n).astype("<u4") for n in (0, 5, BLOCK_IDS, 3 * BLOCK_IDS + 7, 1)]
    for i, d in enumerate(docs):
        w.add(None if i == 1 else i, d.tobytes())
    w.write(f"{tmp_path}/x.tok")
    f, flat = TokenFile(f"{tmp_path}/x.tok"), np.concatenate(docs)
    for a, b in ((0, 3), (BLOCK_IDS - 2, BLOCK_IDS + 9), (0, len(flat)), (len(flat) - 1, len(flat))):
        assert (np.concatenate(list(f.ids(a, b))) == flat[a:b]).all()
    assert f.starts.tolist() == np.cumsum([0] + [len(d) for d in docs])[:-1].tolist()


def expected(rows):
    out = {}
    for d, t in rows:
        out.setdefault(d, []).append(np.array([*whole(t), 0], dtype="<u4"))
    return out


def test_round_trip_of_odd_rows(spark, odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    got = sorted(tokens_round_trip(odd_documents).collect(), key=lambda r: r["start"])
    want = expected(rows)
    assert len(got) == len(rows) and [r["doc_id"] for r in got[:3]] == [None] * 3
    assert [r["doc_id"] for r in got[3:]] == sorted(d for d, _ in rows if d is not None)
    at = 0
    for r in got:
        assert r["start"] == at and r["ids_crc32"] in {zlib.crc32(x.tobytes()) for x in want[r["doc_id"]]}
        at += r["n_tokens"]
    assert tokens_round_trip(no_documents).count() == 0


def test_packing_of_odd_rows(spark, odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    want, got = expected(rows), packed_documents(odd_documents).collect()
    assert sum(r["length"] for r in got) == sum(len(x) for v in want.values() for x in v)
    for r in got:
        assert r["ids_crc32"] in {zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) for x in want[r["doc_id"]]}
        assert 0 < r["length"] <= 2048 and (r["piece"] == 0 or r["length"] == 2048)
    check_sequences(got, 2048)
    assert packed_documents(no_documents).count() == 0


def check_sequences(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_every_capacity_holds(spark):
    lengths = np.random.default_rng(1).integers(1, 400, 500)
    for rule in ("norm", "dot"):
        where, offset = vector_best_fit(lengths, 1000, 5, 300_000, rule)
        for b in np.unique(where):
            own = lengths[where == b]
            assert own.sum() <= 1000 and len(own) <= 5 and (own ** 2).sum() <= 300_000
    where, _ = vector_best_fit(lengths, 1000, 1000, 1_000_000)
    assert len(np.unique(where)) <= -(-lengths.sum() // 1000) + 1


def test_groups_are_packed_apart(spark):
    from lodestone.session import cut_lineage
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('word and more ', cast(id % 90 as int)) as text")
    rows = pack(cut_lineage(token_pieces(docs)), group_pieces=100).collect()
    assert len(check_sequences(rows, 2048)) <= -(-sum(r["length"] for r in rows) // 2048) + 4


class Counted:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode(self, text, **options):
        self.chars += len(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_words_and_marks_after_them_match_no_pattern():
    words = ["".join(chr(97 + (i * k + k) % 26) for k in range(1, 9)) + "é" * (i % 3) for i in range(26)]
    text = "\n".join(f"{w} A{w}*** {w.upper()}.### {w}, ({w}) {i}" for i, w in enumerate(words))
    enc = TextEncoder(default_path())
    enc.tokenizer = Counted(enc.tokenizer)
    assert np.frombuffer(enc.ids(text), dtype="<u4").tolist() == whole(text)
    assert enc.tokenizer.chars < len(text) / 2  # the words in brackets, the numbers, each kind of marks


def test_every_letter_of_arrow_is_one_of_the_tokenizer():
    letters = list(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    letters = [c for c, a in zip(letters, pc.utf8_is_alpha(pa.array(letters)).to_pylist()) if a or c.isalpha()]
    words = " ".join(f"a{c}a" for c in letters)
    assert len(encoder(default_path()).tokenizer.pre_tokenizer.pre_tokenize_str(words)) == len(letters) > 100_000


def test_parts_are_forgotten_beyond_the_limit():
    enc = TextEncoder(default_path(), limit=40, longest=12)
    texts = [f"one {i} and {i}th word\nUnrememberable{'x' * i}! 'tis {i}'s" for i in range(60)]
    for most in (1, 200, 10_000):
        got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in enc.encode(iter([*texts, None, "", "a\0b c"]), most)]
        assert got == [whole(t) for t in [*texts, None, "", "a\0b c"]]
        assert len(enc._known) <= 40 and len(enc._known) == len(enc._ranges[1])
        assert not any("remember" in m for m in enc._known.to_pylist())


def test_vocabularies_without_a_free_byte_are_encoded_whole(tmp_path):
    spec = json.loads(open(default_path(), encoding="utf-8").read())
    spec["model"]["ignore_merges"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec), encoding="utf-8")
    enc, text = TextEncoder(f"{tmp_path}/t.json"), "Some words, and\nothers."
    want = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert not enc.cuts and np.frombuffer(enc.ids(text), dtype="<u4").tolist() == want


def test_ids_keep_their_documents_across_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = [(i, None if i % 7 == 3 else f"text {i} of\nmany " * (i % 5) + "end") for i in range(40)]
    try:
        spark.conf.set(key, "3")
        got = tokens_round_trip(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    finally:
        spark.conf.set(key, before)
    at = 0
    for (doc_id, text), r in zip(rows, got, strict=True):
        ids = np.array([*whole(text), 0], dtype="<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
