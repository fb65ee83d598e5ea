"""Exact round trips: BPE against the public library, WARC against what was written."""

import base64
import hashlib
import io
import random

import public_tokenizers as P
import pytest
import tiktoken

from barsmith.llm import bpe, warc

RANKS = P.path("byte_bpe_50k.tiktoken")
ODD = ["", "a  b c \x1c\x1d x", "'s 'S don't  \n\n x", "日本語 テスト１２３", "😀😀 a", "a" * 300, "  　x\x85y", "  lead", "trail   ", "\t\t\na\r\n",
       "é" * 50 + "¼½٣", "the " * 3000, "<|endoftext|> x", "qwrtpsdfghjkl" * 9]


def test_ids_equal_the_library_and_decode_back(spark):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("abcdefg '\n0 1é") for _ in range(200)) for _ in range(40)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, "", "clash"), (999, None, "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode(df, RANKS, P.PATTERN, round_trip=True)
    for r in got.collect():
        t = texts[r.doc_id] if r.doc_id < 999 else ""
        assert list(r.ids) == enc.encode_ordinary(t) and bytes(r.decoded) == t.encode()
    back = bpe.decode(got.drop("decoded"), RANKS).collect()
    assert len(back) == len(rows) and all(bytes(r.decoded) == (texts[r.doc_id] if r.doc_id < 999 else "").encode() for r in back)
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).collect() == []


def test_an_unknown_id_fails():
    codec = bpe.Codec(bpe.read_ranks(RANKS))
    with pytest.raises(ValueError, match="vocabulary"):
        import numpy as np
        codec.decode(np.array([1, 60_000]), np.array([2]))


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_archives_round_trip(spark):
    rng = random.Random(7)
    page = "<html>" + "".join(rng.choice("abcdef <>/") for _ in range(3000)) + "é</html>"
    rows = [(1, "http://a/ b\r\n", page), (2, None, page), (3, "http://é", None), (4, "u", ""), (5, "u", page + "x" * 400_000), (6, "u", page), (None, "n", page), (6, "u", page)]
    rows += [(100 + i, f"http://h/{i}", page[i:]) for i in range(300)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload string, id int")
    for small in (1 << 16, 1 << 26):
        manifest = warc.write_archives(df, archive_bytes=small)
        got = sorted((tuple(r) for r in warc.read_archives(manifest, with_payload=True).select("id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()), key=repr)
        top = {}
        for i, _, h in rows:
            top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
        want = []
        for i, _, h in rows:
            b, last = (h or "").encode(), top[h or ""]
            whole = i == last
            want.append((i, len(b), digest(b), "response" if whole else "revisit", None if whole else last, bytearray(b) if whole else None))
        assert got == sorted(want, key=repr)
    assert manifest.count() < 60


def test_small_payloads_are_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.id: (r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(df, min_bytes=3)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
    assert warc.read_archives(warc.write_archives(df.limit(0))).collect() == []


def archive(records, dictionary=b""):
    sink = io.BytesIO()
    writer = warc.ArchiveWriter(sink, dictionary)
    for head, block in records:
        writer.record(head, block)
    return sink.getvalue()


HEAD = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Date", warc.DATE)]


def test_reader_checks_frames_heads_and_lengths():
    good = archive([(HEAD, b"HTTP/1.1 200 OK\r\n\r\nbody")] * 3, b"some text of a dictionary " * 9)
    assert [warc.parse_record(d).block[-4:] for d in warc.read_frames(io.BytesIO(good))] == [b"body"] * 3
    for bad, what in ((good[:-5], "cut off"), (good[:6], "short"), (b"WARC/1.1" + good, "dictionary")):
        with pytest.raises(ValueError, match=what):
            list(warc.read_frames(io.BytesIO(bad)))
    data = next(iter(warc.read_frames(io.BytesIO(good))))
    for a, b, what in ((b"WARC/1.1", b"WARC/9.9", "version"), (b"Content-Length: 23", b"Content-Length: 22", "Content-Length"),
                       (b"WARC-Date: ", b"WARC-Xate: ", "WARC-Date"), (b"WARC-Type: ", b"WARC-Type_ ", "field")):
        with pytest.raises(ValueError, match=what):
            warc.parse_record(data.replace(a, b, 1))
    record = warc.parse_record(data)
    record.head["WARC-Payload-Digest"] = "sha1:" + digest(b"other")
    record.block = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nbody"
    with pytest.raises(ValueError, match="digest"):
        warc.check_payload(record)
