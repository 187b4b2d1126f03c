import random

import pytest

from riskloom.llm import mixing
from riskloom.llm.mixing import label_domains, mix, weighted
from tests.llm.helpers import empty_docs, odd_docs

TARGETS = {"left": 0.7, "right": 0.25, "none": 0.05}


def corpus(frame):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(300):
        side = "left" if i % 3 else "right"
        words = [f"{side}{draw.randrange(30)}" if draw.random() < 0.6 else f"shared{draw.randrange(30)}" for _ in range(draw.choice([20, 100]))]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, side))
    return frame(rows, "doc_id long, text string"), frame(labels, "__id long, __domain string")


def test_expected_totals_meet_reachable_targets(frame):
    docs, labelled = corpus(frame)
    targets = {"left": 0.5, "right": 0.5}
    rows = mix(docs, labelled, targets).collect()
    whole = sum(r.n_tokens for r in rows)
    assert whole == sum(len(r.text.split()) for r in docs.collect())
    for domain, share in targets.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{domain}"] for r in rows) / whole - share) < 1e-3
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert all(abs(r.p_left + r.p_right - 1) < 1e-9 for r in rows)
    right = sum((r.domain == "left") == (r.doc_id % 3 > 0) for r in rows)
    assert right >= 0.98 * len(rows)


def test_rates_equal_plain_projected_gradient(frame):
    docs, labelled = corpus(frame)
    targets = {"left": 0.05, "right": 0.95}
    rows = mix(docs, labelled, targets).collect()
    p = [[r.p_left, r.p_right] for r in rows]
    tokens, rates = [r.n_tokens for r in rows], [1.0] * len(rows)
    totals = lambda: [sum(a * t * q[k] for a, t, q in zip(rates, tokens, p, strict=True)) for k in (0, 1)]
    mass, whole = totals(), sum(tokens)
    before = float("inf")
    for _ in range(mixing.ITERATIONS):
        missed = [s - whole * t for s, t in zip(totals(), targets.values(), strict=True)]
        error = sum(m * m / own for m, own in zip(missed, mass, strict=True)) ** 0.5
        if max(map(abs, missed)) <= mixing.TOLERANCE * whole or error >= before * (1 - mixing.PROGRESS):
            break
        before = error
        rates = [max(0.0, a - sum(q[k] * missed[k] / mass[k] for k in (0, 1))) for a, q in zip(rates, p, strict=True)]
    assert [r.rate for r in rows] == pytest.approx(rates, rel=1e-6, abs=1e-9)


def test_labelled_domains(frame):
    docs = frame([(1, "en"), (2, "de"), (3, "fr"), (4, None), (None, "es")], "doc_id long, lang string")
    labels = frame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, None), (4, 1, 0), (None, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in label_domains(docs, labels).collect()} == {(1, "low"), (2, "toxic"), (3, "fr")}


def test_odd_rows(spark, frame):
    docs, labelled = odd_docs(spark), frame([(7, "left"), (8, "right"), (None, "left"), (4, "unknown")], "__id long, __domain string")
    rows = mix(docs, labelled, TARGETS).collect()
    assert len(rows) == 12
    for r in rows:
        assert r.rate >= 0 and abs(r.p_left + r.p_right + r.p_none - 1) < 1e-9
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    kept = weighted(docs, labelled, TARGETS)
    assert kept.columns == [*docs.columns, "mix_rate", "mix_copies"] and kept.count() == 12
    nothing = frame([], "__id long, __domain string")
    assert all(r.p_left == pytest.approx(1 / 3) for r in mix(docs, nothing, TARGETS).collect())
    assert mix(empty_docs(spark), labelled, TARGETS).count() == 0
