import hashlib
import random
import re

import pytest

from tidewatch.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, w string, n_words int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        w = WORD.findall(lowered(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    out = []
    for doc_id, text, *_ in docs:
        w = WORD.findall(lowered(text))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def tables(spark):
    rng = random.Random(1)
    vocab = "alpha beta gamma Delta über 42 naïve zeta".split()
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 9)))) for i in range(25)] + [(3, "alpha beta"), (99, None), (98, ""), (None, "beta gamma")]
    docs = [(i, rng.choice([" ", "-", ". "]).join(rng.choice(vocab) for _ in range(rng.randrange(0, 40))), "x", i) for i in range(60)]
    docs += [(1, docs[1][1], "x", 0), (200, None, None, None), (201, "", "x", 0), (202, "À la BETA " * 3000, "x", 0)]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), docs, items


@pytest.mark.parametrize("window", [4, 10])
@pytest.mark.parametrize("set_hashes", [decontaminate.SET_HASHES, 5])
def test_report_equals_brute_force(tables, window, set_hashes):
    docs, items, doc_rows, item_rows = tables
    out = decontaminate.report(docs, items, window, set_hashes=set_hashes)
    got = sorted([tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in out.collect()], key=repr)
    assert got == brute(doc_rows, item_rows, window)


@pytest.mark.parametrize("set_hashes", [decontaminate.SET_HASHES, 5])
def test_removal(spark, set_hashes):
    docs = spark.createDataFrame([(1, "Say: one two, THREE four! end", "a", 1), (2, "nothing here", "b", 2), (3, None, "c", 3)], SCHEMA)
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, items, set_hashes=set_hashes)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    cleaned = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items, "spans", set_hashes=set_hashes).collect()}
    assert cleaned == {1: "Say:  ,  ! end", 2: "nothing here", 3: None}
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 3
    unnamed = spark.createDataFrame([(None, "one two three four")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, unnamed).collect()) == [2, 3]
    assert [(r["n_hit"], r["n_items"]) for r in decontaminate.report(docs, unnamed).where("doc_id = 1").collect()] == [(4, 0)]
    assert decontaminate.report(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, items, "nothing")
