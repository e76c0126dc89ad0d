import random
import time

import numpy as np
import pytest

from cladeworks.llm import leaks as lk
from cladeworks.llm.canonical import canonicaliser, tables

pytestmark = pytest.mark.usefixtures("spark")


def FORM(text):
    return canonicaliser(tables())(text)


def shares(a, b, width):
    grams = {tuple(b[k : k + width]) for k in range(len(b) - width + 1)}
    return any(tuple(a[k : k + width]) in grams for k in range(len(a) - width + 1))


def brute_tiles(item, doc, width):
    """Greedy string tiling by its definition: again and again the longest match of free words."""
    fi, fd, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and fi[p + n] and fd[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < width:
            return out
        for k in range(n):
            fi[p + k] = fd[t + k] = False
        out.append((p, t, n))


def test_tiles_are_greedy():
    r = random.Random(4)
    for _ in range(60):
        item, doc = [r.choice([1, 2, 3]) for _ in range(25)], [r.choice([1, 2, 3]) for _ in range(30)]
        got = lk.tiles(np.array(item), np.array(doc), 3)
        assert got == lk.tiles(np.array(item), np.array(doc), 3, most=5)
        want = brute_tiles(item, doc, 3)
        assert sorted(n for *_, n in got) == sorted(n for *_, n in want)
        for p, t, n in got:
            assert item[p : p + n] == doc[t : t + n]
        assert len({p + k for p, _, n in got for k in range(n)}) == sum(n for *_, n in got)


def make(seed=2):
    r = random.Random(seed)
    items = [(i, " ".join(f"w{r.randrange(50)}" for _ in range(r.choice([5, 14, 40])))) for i in range(12)]
    items += [(50, items[3][1]), (51, None), (52, "")]
    docs = []
    for d in range(80):
        words = [f"x{r.randrange(99)}" for _ in range(30)]
        if d % 2:
            src = r.choice(items[:12])[1].split()
            n = r.randrange(4, len(src) + 1)
            at = r.randrange(len(src) - n + 1)
            words[10:10] = src[at : at + n]
        text = " ".join(words)
        if d % 3 == 0:
            text = text.upper().replace("W", "Ｗ").replace(" ", ", \n ")
        docs.append((d, text))
    return items, docs


def test_found_against_brute_force(spark, monkeypatch):
    items, docs = make()
    docs += [(100, None), (101, ""), docs[1], (None, docs[1][1]), (102, ". . . ," * 3000 + items[2][1] * 3)]
    i = spark.createDataFrame([(a, b, "t") for a, b in items], "item_id bigint, text string, doc_id string")
    d = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id bigint, text string, item_id int")
    want = {
        (a, k) for a, t in docs for k, q in items
        if a is not None and t and q and shares(lk.words(t, FORM), lk.words(q, FORM), 12)
    }
    assert want
    for table_bytes, sent in ((lk.TABLE_BYTES, lk.SENT_CHARS), (512, 0)):
        # a table too small for the windows and items joined by a shuffle give the same
        monkeypatch.setattr(lk, "TABLE_BYTES", table_bytes)
        monkeypatch.setattr(lk, "SENT_CHARS", sent)
        got = [(r["doc_id"], r["item_id"]) for r in lk.leaks(d, i).collect()]
        assert set(got) == want and len(got) == len(want)
    assert lk.leaks(d.limit(0), i).collect() == [] and lk.leaks(d, i.limit(0)).collect() == []


def test_reordered_passages_are_covered():
    text = [f"a{k}" for k in range(40)]
    moved = [*text[20:], "between", *text[:20]]
    assert lk.tile_pair(text, [moved], 12) == (2, 40, 20)
    assert lk.tile_pair(text, [moved[:11]], 12) == (0, 0, 0)
    assert lk.tile_pair(text, [text[:15], text[15:30]], 12) == (2, 30, 15)


def test_spans_join_where_they_touch():
    assert lk.spans(np.array([3, 4, 9, 21, 40]), 12) == [(3, 33), (40, 52)]
    assert lk.spans(np.array([], int), 12) == []


def test_text_that_repeats_itself_stays_quick():
    for item, doc in ((600, 2000), (1200, 4000)):
        began = time.process_time()
        assert lk.tile_pair(["ab"] * item, [["ab"] * doc], 12) == (1, item, item)
        assert lk.tile_pair(["a", "b"] * (item // 2), [["a", "b"] * (doc // 2)], 12) == (1, item, item)
        assert time.process_time() - began < 5


def test_bits_hold_all_windows(spark):
    h = [random.Random(k).getrandbits(63) for k in range(3000)]
    held = lk.bit_table(spark.createDataFrame([(x,) for x in h], "h bigint"), len(h))
    other = np.array([random.Random(-k).getrandbits(63) for k in range(5000, 105000)], np.uint64)
    assert len(lk.passing(np.array(h, np.uint64), held)) == len(h) and len(lk.passing(other, held)) < 100
