from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from flowtide.llm import personal_data as pii

#: The contract's patterns as they stand there.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS.values()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choice("12+@.- a(%:\n") for _ in range(rng.randint(0, 30))) for _ in range(30_000)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(60)) for _ in range(6000)]
    texts += ["a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "4111111111111111", "x" * 300 + "@", "ü@b.de"]
    assert all(pii.base_spans(t) == brute(t) for t in texts)
    assert sum(len(brute(t)) for t in texts) > 250


def test_long_runs_of_one_character_take_linear_time():
    for c in ("1", "a", "@", "+1", "1.", "- ", "a.", "@a"):
        text = c * 200_000
        pii.mentions(text, pii.base_spans(text))


def card(i):
    body = f"4{i:014d}"
    return next(body + str(d) for d in range(10) if pii.luhn(body + str(d)))


def planted(rng):
    """Texts whose cue words foretell a kind, in the seeds' notation and in others."""
    words = ["lorem", "ipsum", "dolor", "amet", "sed", "quia"]
    noise = lambda: " ".join(rng.choice(words) + (f"{rng.randint(1, 99)}" if rng.random() < 0.1 else "") for _ in range(5))
    rows = []
    for i in range(60):
        rows.append(f"{noise()} please call us at +1 ({100 + i}) 555-{1000 + i} during {noise()}")
        rows.append(f"{noise()} card number: {card(i)} expires soon {noise()}")
        rows.append(f"{noise()} the host at 10.0.{i}.7 went down {noise()}")
    return rows


def spans(found):
    return {r.doc_id: {(s.kind, s.start, s.end) for s in r.added} for r in found.collect()}


def test_contexts_and_forms_discover_unseen_identifiers(spark):
    rng = random.Random(4)
    extra = {
        1000: ("phone", "x please call us at (217) 555-0199 during the day", "(217) 555-0199"),
        1001: ("phone", "two of them: +1 (999) 555-4081 190.137.223.204", "+1 (999) 555-4081"),
        1002: ("card", "no base match: 7000000000000001 " + card(777) + " here", card(777)),
        1003: ("ip", "now the host at 2001:db8::7 went down", "2001:db8::7"),
    }
    clean = {2000: "chapter 12 of 2024-01-05, version 4.0.1, 12345678 items", 2001: None, 2002: "", 2003: "call 5 at 7"}
    rows = list(enumerate(planted(rng))) + [(k, v[1]) for k, v in extra.items()] + list(clean.items())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = pii.find(docs)
    added = spans(found)
    for key, (kind, text, value) in extra.items():
        start = text.index(value)
        assert (pii.KINDS.index(kind), start, start + len(value)) in added[key], (key, added[key])
    assert all(not added[k] for k in clean)
    assert all(not added[k] for k in range(180))
    base = {r.doc_id: [tuple(s) for s in r.base] for r in found.collect()}
    assert all(base[k] == brute(t or "") for k, t in rows)
    listed = found.where("doc_id = 1001").select(pii.listed(pii.all_spans(F.col("base"), F.col("added")))).first()[0]
    assert listed == "ip:31:46,phone:13:30"


def test_copies_do_not_lift_a_pattern(spark):
    same = "please ring +1 (217) 555-0100 today"
    rows = [(i, same) for i in range(200)] + [(900, "please ring 555-0123-77 today"), (901, same.replace("+1 ", ""))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert not any(spans(pii.find(docs)).values())


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (None, "x 10.0.0.1"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = docs.withColumns({c: F.lit("own") for c in ("row", "base", "mentions", "added", "value", "kind")})
    got = pii.find(clash)
    assert got.columns == ["doc_id", "row", "mentions", "value", "kind", "base", "added"] and got.count() == 4
    assert sorted((r.doc_id or 0, len(r.base)) for r in got.collect()) == [(0, 0), (0, 1), (1, 1), (1, 1)]
    assert {(r.value, r.row, r.mentions) for r in got.collect()} == {("own",) * 3}
    assert pii.find(docs, keep=[]).columns == ["base", "added"]
    assert pii.find(docs.where("false")).count() == 0


def test_overlaps_go_to_the_higher_score_then_the_longer():
    assert pii._settled([(3, 0, 5, 0.9), (2, 3, 9, 0.95), (3, 9, 12, 0.9), (3, 9, 11, 0.9)]) == [(2, 3, 9), (3, 9, 12)]
