"""Fill-in-the-middle against a plain version, and its chunks."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailweave.llm import fill_in_middle as fim


def plain_version(key, text, rate=100, spm_rate=50):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[k * 8 : k * 8 + 8], 16) for k in range(4)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, t
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rng = np.random.default_rng(4)
    passage = "".join(f"line {k} of a shared passage, grüße 漢字\n" for k in range(400))
    return [
        None, "", "\n", "\n\n\n", "no end", "one\n", "a\nb", "\na", "x<P>y\nz", "<S", "P>\n<", "<M>",
        passage, "intro\n" + passage, passage[:-1], "é" * 30_000, "ab\n" * 60_000, "x" * 300_000 + "\n" + passage,
        "".join(rng.choice(list("ab \né漢"), 50_000)), passage[:6000] + "<S>" + passage,
    ]


@pytest.mark.parametrize("rate,spm_rate", [(100, 50), (40, 50), (0, 50), (100, 0)])
def test_equal_to_the_plain_version(spark, rate, spm_rate):
    rows = [(k, t, "x") for k, t in enumerate(odd_texts())] + [(None, "a\nb\nc\n", "y"), (3, "again\nand again", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, form string")
    out = fim.fill_in_middle(df, rate=rate, spm_rate=spm_rate)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = out.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, r.text, rate, spm_rate)
        assert r.again == (r.text or "")


def test_given_documents(docs):
    found = fim.fill_in_middle(docs.select("doc_id", "text")).collect()
    assert len(found) == docs.count() and {r.form for r in found} >= {"psm", "spm"}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, r.text)


def test_empty_table_and_odd_documents(none, odd):
    assert fim.fill_in_middle(none).count() == 0
    found = fim.fill_in_middle(odd)
    assert found.count() == odd.count() and {"lang", "source", "score"} < {*found.columns}


def test_chunks_follow_the_content():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 60_000, dtype=np.uint8).tobytes()

    def chunks(data):
        cuts = [0, *fim.chunk_ends(fim.marked_places(np.frombuffer(data, np.uint8)).tolist(), 0, len(data))]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    one, two = chunks(shared), chunks(b"another start of some length" * 9 + shared)
    assert b"".join(one) == shared and all(len(c) <= fim.MOST for c in one)
    assert all(len(c) >= fim.LEAST for c in one[:-1]) and len(one) > 20
    assert len({*one} & {*two}) >= len(one) - 3


def test_places_do_not_depend_on_the_blocks(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 5000, dtype=np.uint8)
    whole = fim.marked_places(data).tolist()
    monkeypatch.setattr(fim, "BLOCK", 700)
    assert fim.marked_places(data).tolist() == whole

    def slow(i):
        h = 0
        for b in data[i - fim.WINDOW : i]:
            h = (2 * h + int(fim.GEAR[b])) % (1 << 32)
        return h

    full = [p for p in whole if p >= fim.WINDOW]
    assert full == [i for i in range(fim.WINDOW, len(data) + 1) if slow(i) < 1 << (32 - fim.MEAN_BITS)]


def test_shared_chunks_are_counted_once_and_memory_is_bounded():
    text = "".join(f"passage line {k} with words\n" for k in range(3000)).encode()
    memo = fim.Memo()
    cuts = fim.chunk_ends(fim.marked_places(np.frombuffer(text, np.uint8)).tolist(), 0, len(text))
    for _ in range(3):
        lines = fim.Lines(memoryview(text), 0, len(text), cuts, memo)
        assert lines.count == 3000
    assert memo.misses == len({*memo.known}) and memo.hits >= 2 * len(cuts)
    small = fim.Memo(10_000)
    assert fim.Lines(memoryview(text), 0, len(text), cuts, small).behind(1234) == lines.behind(1234)
    assert small.held <= 10_000


@pytest.mark.parametrize("split", [1, 2, 3, 4])
def test_marks_over_borders_of_chunks(split):
    text = b"a<S>b"
    cuts = [split, len(text)] if split < len(text) else [len(text)]
    assert fim.Lines(memoryview(text), 0, len(text), cuts, fim.Memo()).marked
    each = fim.Lines(memoryview(text), 0, len(text), [1, 2, 3, 4, 5], fim.Memo())
    assert each.marked and each.count == 1
