"""Token files and WARC archives: exact round trips, and what broken files do."""

import base64
import hashlib
import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from groundshift.llm import tokenfile, warc, wordpool
from groundshift.llm.scratch import filesystem, new_folder

BPE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a", " a", "  a", "a  b", "a \n b\n\n c", "\x1c \x1cx y", "it's  'll we 've<|endoftext|> x", "a b 　c", "\x85 x\t y", "12 34  56 a1 1a !! ?", "é中文 😀 x" * 50]


@pytest.fixture(scope="module")
def bpe():
    tokenizer = Tokenizer.from_file(BPE)
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2]


def test_parts_encode_like_the_whole(bpe):
    encode = tokenfile.Encoder(BPE)
    end = "<|endoftext|>"
    added = [end, end + end, f"a {end} b", f"a  {end}  b", f"{end}a", f"a{end}", f" {end}\n", "<|endof text|>", f"a {end[:-1]} b"]
    spaces = [f"a {chr(c)} b{chr(c)}" for c in range(0x3100) if chr(c).isspace() or c < 0x20]
    texts = [*TEXTS, *TEXTS, "".join(TEXTS), None, *added, *spaces]
    for some in (texts, texts[::-1], ["only one"], []):
        for text, ids in zip(some, encode.texts(pa.array(some, pa.string()), 2), strict=True):
            assert ids == np.array(bpe(text), "<u4").tobytes(), repr(text)


def test_small_pools_and_slices_change_nothing(bpe, monkeypatch):
    monkeypatch.setattr(tokenfile, "PARTS", 3)
    monkeypatch.setattr(tokenfile, "TOGETHER", 2)
    monkeypatch.setattr(wordpool, "SLICE_BYTES", 8)
    encode, batch = tokenfile.Encoder(BPE), pa.record_batch({"i": list(range(len(TEXTS))), "t": TEXTS})
    for i, ids in tokenfile.encoded([batch, batch], encode, 2):
        assert ids == np.array(bpe(TEXTS[i]), "<u4").tobytes()


def test_dictionary_samples_come_from_the_whole_text():
    ids = np.arange(100_000, dtype="<u4")
    some = np.frombuffer(tokenfile.spread_sample(ids.tobytes()), "<u4")
    assert len(some) <= tokenfile.SAMPLE_IDS and some[0] == 0 and some[-1] == 99_999


def test_documents_come_back_in_order(spark, docs, bpe):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id"), (7, None), (50, "tie"), (50, "tie"), (51, "word " * 60_000)]
    folder = new_folder(spark, "ids")
    shards = tokenfile.write(docs(rows), folder, BPE, 2)
    out = sorted(tokenfile.read(spark, shards, folder).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in out]
    assert ids[0] is None and ids[1:] == sorted(i for i, _ in rows if i is not None)
    at = 0
    left = [(i, np.array(bpe(t), "<u4").tobytes()) for i, t in rows]
    for r in out:
        assert r.start == at
        at += r.n_tokens
        left.remove(next((i, b) for i, b in left if i == r.doc_id and zlib.crc32(b) == r.ids_crc32 and len(b) == 4 * r.n_tokens))
    assert not left
    path = next(r.path for r in shards.collect() if 51 in tokenfile.Shard.open(filesystem(folder)[0], r.path).index["doc_id"])
    assert tokenfile.lookup(folder, path, 51).tolist() == bpe("word " * 60_000)
    with pytest.raises(ValueError, match="dictionary"):
        tokenfile.Shard.open(filesystem(folder)[0], path, b"another")


def test_cut_shard_is_refused(tmp_path):
    (tmp_path / "x.ids").write_bytes(tokenfile.MAGIC + bytes(80))
    with pytest.raises(ValueError, match="cut off"):
        tokenfile.Shard.open(filesystem(str(tmp_path))[0], str(tmp_path / "x.ids"), b"")


def test_no_documents(spark, docs):
    folder = new_folder(spark, "ids")
    assert tokenfile.read(spark, tokenfile.write(docs([(1, "a")]).limit(0), folder, BPE), folder).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, revisits string, KEY int")


def test_records_come_back(spark, same_rows):
    rows = [(i, f"http://a/{i}", f"<p>{i % 7}</p>" * (i % 7)) for i in range(60)]
    rows += [(70, None, None), (71, "u\r\nX: y", ""), (None, "u", "lonely"), (None, "u", "<p>1</p>"), (80, "u", "ü" * 200_000), (81, "u", "twice"), (81, "u", "twice"), (79, "u", "twice")]
    for least in (0, 9):
        last = {}
        for i, _, html in rows:
            if i is not None and len((html or "").encode()) >= least:
                last[html or ""] = max(i, last.get(html or "", i))
        want = []
        for i, _, html in rows:
            data = (html or "").encode()
            to = last.get(html or "")
            to = None if to == i else to
            sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
            want.append((i, len(data), sha, "response" if to is None else "revisit", to))
        folder = new_folder(spark, "warc")
        archives = warc.write(pages(spark, rows), folder, least)
        out = warc.read(spark, archives, folder)
        same_rows(out.drop("url").collect(), want)
    folder = new_folder(spark, "warc")
    assert warc.read(spark, warc.write(pages(spark, rows[:1]).limit(0), folder), folder).count() == 0


def archive(*records, dictionary=b"WARC/1.1 response" * 20):
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return warc.archive_head(dictionary) + b"".join(packer.compress(r) for r in records)


def test_reader_refuses_what_does_not_agree():
    good = warc.record(1, "u", b"body", None)
    assert warc.parse(good)["payload_bytes"] == 4
    assert list(warc.read_archive(io.BytesIO(archive(good, good)))) == [good, good]
    plain = b"dict" * 10
    raw = struct.pack("<II", warc.DICTIONARY_FRAME, len(plain)) + plain
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(plain))
    assert list(warc.read_archive(io.BytesIO(raw + packer.compress(good)))) == [good]
    for bad in (archive(good)[:-3], archive(good)[8:], b"\x28\xb5"):
        with pytest.raises((ValueError, struct.error, zstandard.ZstdError)):
            list(warc.read_archive(io.BytesIO(bad)))
    for bad in (good[:-1], good.replace(b"body", b"bodx"), good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"Content-Type: app", b"Content-Type app"), b""):
        with pytest.raises(ValueError):
            warc.parse(bad)
