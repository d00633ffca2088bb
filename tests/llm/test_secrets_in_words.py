"""Several secrets in one blank-separated word."""

from __future__ import annotations

import random

from flowtide.llm import secret_scan

SCHEMA = "doc_id long, text string, source string"
R = random.Random(8)


def secret():
    return "".join(R.choice("0123456789abcdef") for _ in range(38)) + "a1"


def test_every_run_of_a_word_is_a_candidate(spark):
    a, b, c, d = (secret() for _ in range(4))
    rows = [
        (1, 'x {"aws_secret_access_key":"' + a + '"} y', "a"),
        (2, f"authorization_bearer:{b}", "a"),
        (3, '{"user":"' + c + '","api_token":"' + d + '","plain":"short1"}', "a"),
        (4, f"{a},{b},{c}", "a"),
        (5, f"only_letters_without_digits:{'x' * 20},{a}", "a"),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    found = secret_scan.features(secret_scan.candidates(table), table).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.key, r.word, r.run)):
        got.setdefault(r.key, []).append(r)
    assert {k: [r.candidate for r in x] for k, x in got.items()} == {1: [a], 2: [b], 3: [c, d], 4: [a, b, c], 5: [a]}
    assert [r.before for r in got[1] + got[2] + got[3]] == ["aws_secret_access_key:", "authorization_bearer:", "user:", "api_token:"]
    assert [(r.named, r.assigned) for r in got[1] + got[2]] == [(1, 1), (1, 1)]
    # Each run has its own name, not that of another run of the word.
    assert [(r.named, r.assigned) for r in got[3]] == [(0, 1), (1, 1)]
    assert [(r.named, r.assigned) for r in got[4]] == [(0, 0)] * 3
    assert got[1][0].before2 == "x" and got[1][0].after == "y" and [r.word for r in got[4]] == [0, 0, 0]
