"""Personal data in texts: exact base patterns, and identifiers found by bootstrapped contextual extraction.

Base patterns give the seeds: e-mail addresses, IP addresses, card numbers that pass Luhn's check, phone numbers.
Mentions are the seeds and every other word with a digit or an at sign, also up to ``NUMBERS`` numeric words in a row;
mentions that overlap a seed are left out. Around a mention lie lexical patterns of two views:

* context: two words to the left; one on either side; two to the right; the left word with the mention's form;
* form: the mention with digits as 9 and letters as a, with runs of them shortened or as long as they are.

Pattern and distinct mentioned values make a bipartite graph. In each round Spark scores it: a pattern's confidence
for a kind is its values known to be of the kind, over all its values plus ``PRIOR``; a value without a kind that its
own form allows takes 1 - (1 - best form) * (1 - best context) over patterns of ``SUPPORT`` known values and a
confidence of ``CONFIDENT`` or more; at ``ACCEPT`` it is known from then on. Known values only grow in number, so
rounds go on until none is added. Values count once however often they are copied, so a group of copies can't lift a pattern.

Every mention of a known value outside base spans becomes a span. Base spans always stay. Where such spans overlap in a text,
the higher score goes first, then the longer, then the earlier one. Base patterns that match too far, such as two numbers
side by side that make one over-long number, lose their match by the contract; the method brings it back.

Null and empty texts have no spans. Rows are told apart by a mark of their own, so ids may repeat or be null. Long
words count as a whole; in a pattern or a value, words of over ``LONG`` characters are stood for by their hash. The caller's
columns stay; those named like a result give way.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.llm.common import store, stored_side

#: Fixed values of the contract: the kinds in their order, and what a base match must look like.
KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No match starts or ends inside a run of digits, so starts within one need no trial.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMBERS, LONG, AROUND = 4, 64, 160
PRIOR, SUPPORT, CONFIDENT, ACCEPT = 1.0, 4, 0.8, 0.9

_BLANKS = " \t\n\x0b\x0c\r"
_MARK = re.compile(r"[0-9@]")
_BLANK = re.compile(r"[\x20\x09-\x0d]")
_WORD = re.compile(r"[^\x20\x09-\x0d]+")
_NUMERIC = re.compile(r"[+(]?[0-9][0-9().\-/]*\)?")
_CUE = re.compile(r"[^\W\d_]{2,}[:=]+")
_BEFORE, _AFTER = "\"'`<[{,.;:!?*#%&$|=~", "\"'`>]},.;:!?*#%&$|=~"

SPAN = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])
_SPAN_FIELDS = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
_MENTION_FIELDS = [
    ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()),
    ("allowed", pa.int32()), ("patterns", pa.list_(pa.string())),
]
MENTION = T.StructType([
    *SPAN.fields, T.StructField("value", T.StringType()), T.StructField("allowed", T.IntegerType()),
    T.StructField("patterns", T.ArrayType(T.StringType())),
])

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the digits pass the check of card numbers."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base patterns' matches that hold, by kind and start."""
    found: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = domain.end()
                found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def allowed_kinds(text: str) -> int:
    """Which kinds a mention's own form allows, as bits by place in ``KINDS``."""
    bits = 0
    name, at, host = text.partition("@")
    if at and name and "@" not in host and not host.startswith(".") and "." in host.rstrip("."):
        bits |= 1
    if "." in text or text.count(":") > 1:
        try:
            ipaddress.ip_address(text)
            bits |= 2
        except ValueError:
            pass
    if not bits and all(_NUMERIC.fullmatch(w) for w in text.split(" ")):
        digits = _digits(text)
        if 13 <= len(digits) <= 19 and not set("+()") & set(text) and luhn(digits):
            bits |= 4
        if 7 <= len(digits) <= 15:
            bits |= 8
    return bits


def _short(word: str) -> str:
    return word if len(word) <= LONG else "~" + hashlib.md5(word.encode()).hexdigest()


def _forms(text: str, allowed: int) -> tuple[str, str]:
    """The mention with digits as 9 and letters as a: runs shortened, and as they are."""
    exact = "".join("9" if "0" <= c <= "9" else "a" if c.isalpha() else c for c in text)
    return _short(f"{re.sub(r'9+', '9', re.sub(r'a+', 'a', exact))}/{allowed}"), _short(f"{exact}/{allowed}")


def _around(text: str, start: int, end: int) -> tuple[str, str, str, str]:
    """Two words on the left, the nearest last, and two on the right, lower-cased, without marks, digits as 9."""
    left = _WORD.findall(text[max(0, start - AROUND) : start])[-2:]
    right = _WORD.findall(text[end : end + AROUND])[:2]
    words = [*["^"] * (2 - len(left)), *left, *right, *["$"] * (2 - len(right))]
    return tuple(_short(re.sub(r"[0-9]+", "9", w.lower().strip(_BEFORE + _AFTER))) for w in words)


def _mention(text: str, start: int, end: int, kind: int | None) -> tuple:
    surface = text[start:end]
    allowed = allowed_kinds(surface)
    l2, l1, r1, r2 = _around(text, start, end)
    form, exact = _forms(surface, allowed)
    patterns = [f"c2|{l2} {l1}", f"cb|{l1} {r1}", f"cr|{r1} {r2}", f"cf|{l1} {form}", f"f|{form}", f"x|{exact}"]
    return kind, start, end, _short(surface.lower()), allowed, patterns


def _words(text: str) -> Iterator[tuple[int, int]]:
    """Words with a digit or an at sign, without marks around them and without a cue before a colon or equals sign."""
    end = 0
    found = _MARK.search(text)
    while found:
        start = found.start()
        while start > end and text[start - 1] not in _BLANKS:
            start -= 1
        blank = _BLANK.search(text, found.end())
        end = blank.start() if blank else len(text)
        first, last = start, end
        while True:
            while first < last and text[first] in _BEFORE:
                first += 1
            cue = _CUE.match(text, first, last)
            if not cue or cue.end() >= last:
                break
            first = cue.end()
        while first < last and text[last - 1] in _AFTER:
            last -= 1
        if first < last:
            yield first, last
        found = _MARK.search(text, end)


def mentions(text: str, base: Sequence[Span]) -> list[tuple]:
    """Seeds and other mentions of a text, with what their forms allow and the patterns around them."""
    taken = sorted((s, e) for _, s, e in base)
    reach = 0
    merged: list[tuple[int, int]] = []
    for s, e in taken:
        if merged and s < reach:
            merged[-1] = (merged[-1][0], max(reach, e))
        else:
            merged.append((s, e))
        reach = merged[-1][1]
    ends = [e for _, e in merged]

    def free(start: int, end: int) -> bool:
        i = bisect_left(ends, start + 1)
        return i == len(merged) or merged[i][0] >= end

    words = list(_words(text))
    numeric = [bool(_NUMERIC.fullmatch(text, s, e)) for s, e in words]
    out = [_mention(text, s, e, k) for k, s, e in base]
    covered = [False] * len(words)
    for i, (start, _) in enumerate(words):
        for n in range(2, NUMBERS + 1):
            j = i + n - 1
            if j >= len(words) or not numeric[i] or not numeric[j] or words[j][0] != words[j - 1][1] + 1:
                break
            if text[words[j - 1][1]] != " ":
                break
            if free(start, words[j][1]) and allowed_kinds(text[start : words[j][1]]):
                out.append(_mention(text, start, words[j][1], None))
                covered[i : j + 1] = [True] * n
    for (start, end), inside in zip(words, covered):
        if free(start, end) and (not inside or allowed_kinds(text[start:end])):
            out.append(_mention(text, start, end, None))
    return out


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Each row as (own, row, base, mentions), stored: the kept columns, a mark of its own, base spans and mentions."""
    own = F.struct(*[docs[c] for c in keep]) if keep else F.struct(F.lit(None).cast("string").alias("none"))
    marked = docs.select(own.alias("own"), F.expr("uuid()").alias("row"), docs[text].alias("mentions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, said = [], []
            for value in batch.column(2).to_pylist():
                if value and _MARK.search(value):
                    spans = base_spans(value)
                    base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                    said.append([dict(zip([n for n, _ in _MENTION_FIELDS], m)) for m in mentions(value, spans)])
                else:
                    base.append([])
                    said.append([])
            found = [pa.array(base, pa.list_(pa.struct(_SPAN_FIELDS))), pa.array(said, pa.list_(pa.struct(_MENTION_FIELDS)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], ["own", "row", "base", "mentions"])

    layout = T.StructType([
        marked.schema["own"], T.StructField("row", T.StringType()), T.StructField("base", T.ArrayType(SPAN)),
        T.StructField("mentions", T.ArrayType(MENTION)),
    ])
    return store(marked.mapInArrow(run, layout), "mentions")


def _patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Patterns sure enough of one kind: (pattern, kind, confidence)."""
    sides = edges.join(known.select("value", F.col("kind").alias("known")), "value", "left")
    counted = sides.groupBy("pattern").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("known") == k).alias(f"n{k}") for k in range(len(KINDS))]
    )
    best = F.greatest(*[F.struct(F.col(f"n{k}").alias("n"), F.lit(-k).alias("kind")) for k in range(len(KINDS))])
    sure = counted.select("pattern", "n", best.alias("best")).select(
        "pattern", (-F.col("best.kind")).alias("kind"), F.col("best.n").alias("known"),
        (F.col("best.n") / (F.col("n") + PRIOR)).alias("confidence"),
    )
    return sure.where((F.col("known") >= SUPPORT) & (F.col("confidence") >= CONFIDENT))


def _scored(edges: DataFrame, values: DataFrame, sure: DataFrame) -> DataFrame:
    """Values without a kind that reach ``ACCEPT``: (value, kind, score)."""
    is_form = F.col("pattern").startswith("f|") | F.col("pattern").startswith("x|")
    open_values = values.where("kind is null and allowed > 0").select("value", "allowed")
    met = edges.join(stored_side(sure, "sure"), "pattern").join(open_values, "value").where(
        F.expr("(shiftright(allowed, kind) & 1) = 1")
    )
    views = met.groupBy("value", "kind").agg(
        F.coalesce(F.max(F.when(is_form, F.col("confidence"))), F.lit(0.0)).alias("form"),
        F.coalesce(F.max(F.when(~is_form, F.col("confidence"))), F.lit(0.0)).alias("context"),
    )
    score = 1 - (1 - F.col("form")) * (1 - F.col("context"))
    best = F.max(F.struct(score.alias("score"), (-F.col("kind")).alias("kind")))
    return views.groupBy("value").agg(best.alias("b")).select(
        "value", (-F.col("b.kind")).cast("int").alias("kind"), F.round("b.score", 6).alias("score")
    ).where(F.col("score") >= ACCEPT)


def bootstrap(scanned: DataFrame) -> DataFrame:
    """Known values with kind and score: the seeds' with a score of 1, and those that patterns discover."""
    said = scanned.select(F.inline("mentions"))
    per_value = said.groupBy("value").agg(F.min("kind").alias("kind"), F.max("allowed").alias("allowed"))
    values = store(per_value, "values")
    edges = store(said.select("value", F.explode("patterns").alias("pattern")).distinct(), "edges")
    known = store(values.where("kind is not null").select("value", "kind", F.lit(1.0).alias("score")), "known")
    while True:
        sure = _patterns(edges, known)
        fresh = store(_scored(edges, values, sure).join(known, "value", "left_anti"), "discovered")
        if fresh.isEmpty():
            return known
        known = store(known.unionByName(fresh), "known")


def _settled(found: list[tuple[int, int, int, float]]) -> list[Span]:
    """Of overlapping spans the one with the higher score, then the longer, then the earlier."""
    chosen: list[Span] = []
    places: list[tuple[int, int]] = []
    for kind, start, end, _ in sorted(found, key=lambda f: (-f[3], f[1] - f[2], f[1], f[0])):
        i = bisect_left(places, (start, start))
        if (i == 0 or places[i - 1][1] <= start) and (i == len(places) or places[i][0] >= end):
            insort(places, (start, end))
            chosen.append((kind, start, end))
    return sorted(chosen)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            [dict(zip(("kind", "start", "end"), s)) for s in _settled([(f["kind"], f["start"], f["end"], f["score"]) for f in row])]
            for row in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.list_(pa.struct(_SPAN_FIELDS)))], ["row", "added"]
        )


def find(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs``, or the columns ``keep``, without the texts and with ``base`` and ``added``: spans (kind, start, end) in code points, end exclusive.

    ``kind`` is a place in ``KINDS``; ``base`` is ordered by kind and start, ``added`` likewise.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (text, "base", "added")]
    scanned = scan(docs, text, kept)
    known = bootstrap(scanned)
    free = scanned.select("row", F.inline("mentions")).where("kind is null").drop("kind", "patterns")
    hits = free.join(stored_side(known, "known"), "value").where(F.expr("(shiftright(allowed, kind) & 1) = 1"))
    per_row = hits.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("found"))
    layout = T.StructType([T.StructField("row", T.StringType()), T.StructField("added", T.ArrayType(SPAN))])
    added = per_row.mapInArrow(_settle, layout)
    none = F.array().cast(T.ArrayType(SPAN))
    joined = scanned.drop("mentions").join(added, "row", "left")
    return joined.select(*[F.col("own")[c].alias(c) for c in kept], "base", F.coalesce("added", none).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def all_spans(base: Column, added: Column) -> Column:
    return F.array_sort(F.array_union(base, added))


def count_of(spans: Column, kind: str) -> Column:
    place = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == place)).cast("long")
