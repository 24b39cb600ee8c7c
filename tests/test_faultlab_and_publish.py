import hashlib
import json

import pytest

from tidewatch.functions import digests
from tidewatch.operators import bars, faultlab, gate, grade, publish, slo
from tidewatch.operators.config import Rules

#: Fixed values that identify the fixture, its faults and its bars.
CONTENT = "942bd683dd7b5433efdb2c3ee1b36060c8c7b944ed1e2f10f365cf40ed1873a6"
FAULTS = "15db5bc09f00df6219fb12c8411371979f093cc5f7e8594672a9faf82bf9f011"


@pytest.fixture(scope="module")
def full(spark):
    clean = faultlab.clean_fixture(spark).persist()
    faulted = faultlab.inject(clean)
    return clean, faulted, faultlab.trades_of(faulted).persist(), faultlab.manifest_of(faulted).persist()


def test_digests_and_counts(full):
    clean, faulted, *_ = full
    assert digests.content_digest(r.asDict() for r in clean.orderBy("seq").toLocalIterator()) == CONTENT
    document = faultlab.manifest_document(faulted)
    assert document["n_total"] == 100_477 and hashlib.sha256(faultlab.manifest_bytes(document)).hexdigest() == FAULTS


def test_grade_and_experiment(full, tmp_path):
    _, faulted, trades, manifest = full
    verdicts = gate.evaluate(trades, divergences=False).persist()
    graded = grade.grade(verdicts, manifest, 100_477)
    recall = {k: round(c["recall"].point, 6) for k, c in graded["classes"].items()}
    assert recall == {"malformed": 1.0, "out-of-range": 1.0, "duplicate": 0.840671, "out-of-order": 1.0}
    assert str(graded["classes"]["duplicate"]["recall"]) == "0.8407 [0.8071, 0.8721]"
    assert all(c["precision"].point == 1.0 for c in graded["classes"].values())
    assert graded["completeness"] == {"total": 100_477, "valid": 98_876, "quarantined": 1_601, "loss": 0, "duplicate": 0}
    found = slo.experiment(trades, manifest, label="x")
    assert found.thesis_holds and (found.on["n_bars"], found.on["n_violations"]) == (15_061, 0)
    assert (found.off["violated_bars"], found.off["no_quarantinable"], found.off["price_positive"]) == (1_076, 1_076, 144)

    counts = grade.counts(verdicts, manifest).first().asDict()
    document = publish.artifact(graded, counts, found, "label", FAULTS, publish.provenance("test", CONTENT, "pin"))
    page = publish.render(document)
    assert "0.8407 [0.8071, 0.8721]" in page and not publish.text_leaks(json.dumps(document))
    for path in ("grade", "slo"):
        with pytest.raises(publish.Leak):
            publish.assert_publishable({k: v for k, v in document.items() if k != path})
    with pytest.raises(publish.Leak):
        publish.assert_publishable(document | {"extra": 1})


def test_small_window(spark):
    rules = Rules(dedup_window=100)
    faulted = faultlab.inject(faultlab.clean_fixture(spark, 300), rules)
    trades, manifest = faultlab.trades_of(faulted).persist(), faultlab.manifest_of(faulted).persist()
    found = slo.experiment(trades, manifest, rules)
    assert (found.on["n_violations"], found.off["violated_bars"], found.off["n_bars"]) == (0, 12, 189) and found.bit_identical
    again = faultlab.inject(faultlab.clean_fixture(spark, 300), rules)
    assert digests.equality_digest(faulted) == digests.equality_digest(again)
    a, b = (digests.verdicts_digest(gate.evaluate(faultlab.trades_of(x), rules)) for x in (faulted, again))
    assert a == b


def test_rigged_grade(spark):
    verdicts = spark.createDataFrame([(0, "quarantine", "R1"), (1, "valid", None), (2, "quarantine", "R2"), (3, "quarantine", "R2"), (4, "quarantine", "R3"), (5, "valid", None), (6, "valid", None), (7, "valid", None)], "seq long, disposition string, rule_id string")
    manifest = spark.createDataFrame(
        [(0, "s", "malformed", True, True, "quarantine", "R1", "", ""), (1, "s", "malformed", True, True, "quarantine", "R1", "", ""), (2, "s", "out-of-range", True, True, "quarantine", "R2", "", ""), (3, "s", "out-of-range", False, True, "valid", None, "", ""), (4, "s", "duplicate", True, True, "quarantine", "R3", "", ""), (5, "s", "duplicate", True, False, "valid", None, "", "")],
        "index long, stream string, fault_class string, is_fault boolean, detectable boolean, expected_disposition string, expected_rule string, boundary string, note string",
    )
    g = grade.grade(verdicts, manifest, 9)
    assert [g["classes"][c]["recall"].point for c in ("malformed", "out-of-range", "duplicate", "out-of-order")] == [0.5, 1.0, 0.5, None]
    assert g["classes"]["out-of-range"]["precision"].point == 0.5 and g["completeness"]["loss"] == 1
    assert round(g["false_quarantine"]["all_controls"].point, 6) == 0.333333 and g["false_quarantine"]["boundary_controls"].point == 1.0


def test_bootstrap():
    assert (grade.proportion(1, 2).ci_low, grade.proportion(1, 2).ci_high) == (0.0, 1.0)
    assert grade.proportion(50, 50).ci_low == 1.0 and not grade.proportion(0, 0).defined and str(grade.proportion(0, 0)) == "n/a (n=0)"
    assert grade.proportion(401, 477).as_dict() == {"point": 0.840671, "ci_low": 0.807128, "ci_high": 0.872117, "n": 477}
    with pytest.raises(ValueError):
        grade.proportion(5, 3)


def test_publishing_gates(spark):
    schema = {"definitions": {"loop": "@loop"}, "root": {"a": "int", "b": "float?", "c": {"d": "bool"}}}
    assert publish.undeclared({"a": 1, "b": None, "c": {"d": True}}, schema) == []
    assert len(publish.undeclared({"a": True, "b": 1, "c": {"d": 1}}, schema)) == 3
    assert publish.undeclared({"a": None, "c": []}, schema) == ["$.a: null", "$.b: missing", "$.c: no object"]
    for root in ("@loop", "@missing"):
        with pytest.raises(publish.Leak):
            publish.undeclared(1, schema | {"root": root})
    assert publish.market_fields({"x": [{"price": 1}], "bid": {}}) == ["$.bid", "$.x[0].price"]
    assert set(publish.market_columns(bars.build(faultlab.clean_fixture(spark, 5)))) >= {"$.bar_open", "$.volume"}
    assert publish.text_leaks('{"vwap" : 1}') == ["vwap"] and publish.market_key_pattern().startswith('"(ask|')
    with pytest.raises(publish.Leak):
        publish.provenance("x", " ", "y")
