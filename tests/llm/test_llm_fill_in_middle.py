import hashlib
import random
import re

import pytest
from llm_data import EDGE_TEXTS, docs_df

from feedloom.llm import fill_in_middle as M


def plain(doc_id, text, rate=100, spm_rate=50):
    """The contract, on whole strings."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()
    if not text or any(m in text for m in M.MARKERS) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def some_rows():
    rng = random.Random(6)
    pieces = ["a line\n", "\n", "no end", "é über ñ 漢字 😀\n", "\r\n", "x" * 50 + "\n", "< P>", "tab\tand \x0b\n"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(100, 300)]
    rows += [(400, "text with <P> inside\nand more"), (401, "<S>"), (402, "ends <M"), (403, "<"), (404, "\n\n\n"), (405, "漢" * 300)]
    return rows + EDGE_TEXTS


@pytest.mark.parametrize("frame", [5, 64, 1 << 16])
def test_against_plain(spark, frame):
    rows = [(i, t) for i, t in some_rows() if frame > 5 or len(t or "") < 9000]
    docs = docs_df(spark, rows, ["frames", "form", "h1", "marked"]).repartition(3)
    kept = M.store(docs, frame_bytes=frame)
    assert all(b - a <= frame for r in kept.collect() for a, b in zip(r["frames"]["bytes"], r["frames"]["bytes"][1:]))
    for rate, spm in ((100, 50), (60, 20)):
        got = M.transform(kept, rate=rate, spm_rate=spm, outputs=False).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(str(plain(i, t, rate, spm)) for i, t in rows)


def test_small_frames_seek_and_find():
    zip_, unzip = M.zstandard.ZstdCompressor(level=1), M.zstandard.ZstdDecompressor()
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab\né<P>") for _ in range(rng.randrange(60))).encode()
        frames = M.Frames()
        at = 0
        while at < len(text):
            size = rng.randrange(1, 9)
            frames.add(text[at:at + size], zip_)
            at += size
        lines = re.findall(rb"[^\n]*\n|[^\n]+", text)
        assert frames.n_units(unzip) == len(lines)
        for k in range(len(lines) + 1):
            head = b"".join(lines[:k])
            assert frames.seek(k, unzip) == (len(head), len(head.decode()))
        for start in range(len(text) + 1):
            assert frames.find(b"<P>", start, unzip) == text.find(b"<P>", start)
            end = rng.randrange(start, len(text) + 1)
            part = M.Frames()
            frames.copy(start, end, part, zip_, unzip)
            assert b"".join(part.part(i, unzip) for i in range(len(part.data))) == text[start:end]


def test_outputs_and_round_trip(spark):
    rows = [(i, t) for i, t in some_rows() if i is not None and i != 7]
    out = M.transform(M.store(docs_df(spark, rows)))
    texts = {r["doc_id"]: r["text"] for r in M.unpacked(out, "output").collect()}
    digests = {r["doc_id"]: r["output_sha256"] for r in out.collect()}
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()} == digests
    back = {r["doc_id"]: r["text"] for r in M.unpacked(M.restore(out)).collect()}
    assert back == {i: t or "" for i, t in rows}


def test_other_markers(spark):
    tags = ("[pre]", "[suf]", "[mid]")
    out = M.transform(M.store(docs_df(spark, [(1, "a\nb\nc\n"), (2, "d\ne\n")]), tags), markers=tags)
    for r in M.unpacked(out, "output").collect():
        assert all(r["text"].count(t) == 1 for t in tags)


def test_empty(spark):
    assert M.transform(M.store(docs_df(spark, []))).collect() == []
