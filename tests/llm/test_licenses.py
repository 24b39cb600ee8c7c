import random

from tidewatch.llm import licenses

SCHEMA = "doc_id long, text string, license string, start int"


def lcs(template, text):
    row = [0] * (len(text) + 1)
    for w in template:
        new = [0]
        for j, x in enumerate(text):
            new.append(max(row[j] + 1 if w == x else 0, row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_is_the_longest_common_subsequence_inside_the_band():
    rng = random.Random(1)
    for _ in range(200):
        template = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        matched, first, last = licenses.align(template, text, 0, 30)
        assert matched == lcs(template, text)
        if matched:
            assert lcs(template, text[first : last + 1]) == matched and text[first] in template and text[last] in template


def test_winnowing_guarantee():
    rng = random.Random(2)
    codes = [rng.randrange(50) for _ in range(200)]
    picked = licenses.winnow(codes)
    assert all(any(s <= p < s + licenses.WINNOW for p in picked) for s in range(len(codes) - licenses.WINNOW + 1))
    assert licenses.winnow([]) == [] and licenses.winnow([7]) == [0]


def test_whole_edited_and_embedded_templates(spark):
    rng = random.Random(3)
    texts, want = [], []
    for name, body in sorted(licenses.TEMPLATES.items()):
        before = "Ünrelated prose — " + " ".join(rng.choice(["foo", "bar", "the"]) for _ in range(rng.randrange(9))) + ".\n"
        texts.append(before + body.upper() + "\nmore prose")
        want.append((name, 1.0, len(before)))
        split = body.split(" ")
        if len(split) > 40:
            edited = [w for i, w in enumerate(split) if i % 11 != 5]
            edited[20:20] = ["inserted", "words"]
            texts.append(before + " ".join(edited))
            want.append((name, None, len(before)))
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], SCHEMA)
    rows = licenses.scan(docs).collect()
    for i, (name, coverage, start) in enumerate(want):
        mine = [r for r in rows if r["doc_id"] == i and r["license"] == name]
        assert len(mine) == 1 and mine[0]["start"] == start
        assert mine[0]["coverage"] == coverage if coverage else 0.8 <= mine[0]["coverage"] < 1
        text = texts[i]
        inside = licenses.words(text[mine[0]["start"] : mine[0]["end"]])
        assert lcs(licenses.words(licenses.TEMPLATES[name]), inside) == mine[0]["matched_words"]


def test_equals_brute_force_over_all_places(spark):
    """Every template against every place of every text, by plain comparison of words."""
    rng = random.Random(4)
    pool = list(licenses.TEMPLATES.values())[:5]
    texts = [" ".join(rng.choice([*pool, "plain words", "licensed under", "version 2.0", "é"]) for _ in range(rng.randrange(0, 8))) for _ in range(80)]
    index = licenses.Index.build()
    for text in texts:
        w = licenses.words(text)
        found = {(f[0], f[4]) for f in index.find(text) if f[3] == 1.0}
        places = [m.start() for m in licenses._WORD.finditer(text)]
        for name, body in licenses.TEMPLATES.items():
            t = licenses.words(body)
            exact = [p for p in range(len(w) - len(t) + 1) if w[p : p + len(t)] == t]
            assert {(name, places[p]) for p in exact} <= found, (name, text)


def test_edges(spark):
    line = licenses.TEMPLATES["mit-notice"]
    docs = spark.createDataFrame([(1, None, "", 0), (2, "", "", 0), (3, line, "", 0), (3, line, "", 0), (4, (line + " filler text here. ") * 500, "", 0), (None, line, "", 0)], SCHEMA)
    rows = licenses.scan(docs).collect()
    assert sorted((r["doc_id"] or 0) for r in rows if r["doc_id"] != 4) == [0, 3, 3]
    assert licenses.scan(docs.limit(0)).count() == 0
    assert licenses.Index.build({"none": " . "}).find(line) == []


def test_edited_short_notices():
    index = licenses.Index.build()
    for text, name in (("Licensed under the Apache Licence, Version 2.0.", "apache-2.0-notice"), ("Released under MIT License", "mit-notice")):
        assert [f[0] for f in index.find("some words " + text + " more")] == [name]
    rng = random.Random(5)
    for name, body in licenses.TEMPLATES.items():
        t = [w.decode() for w in licenses.words(body)]
        if len(t) >= 20:
            continue
        for lost in range(len(t)):
            for kind in range(3):
                edited = t[:lost] + (["zzz"] if kind else []) + t[lost + 1 :]
                if kind == 2:
                    edited.insert(rng.randrange(1, len(edited)), "yyy")
                want = lcs(t, edited) >= licenses.MIN_COVERAGE * len(t)
                got = [f for f in index.find("xxx " * 9 + " ".join(edited) + " xxx" * 9) if f[0] == name]
                assert len(got) == want and all(f[1] == lcs(t, edited) for f in got), (name, edited, got)
