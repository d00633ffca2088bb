"""Pieces of DuckDB SQL that several checks share."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"

CRC_TABLE = """crc_table as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as tab
    from (select cast(range as bigint) as i from range(256)))"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, beside the column ``tab`` of ``crc_table``."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
        string_split({text}, ''), lambda ch: cast(ascii(ch) as bigint))), lambda c, b:
        xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""


def _discounts(counts: str) -> str:
    return f"""(select case when least(a, b, c, d) = 0 then 0.25 else greatest(least(1 - 2 * y * b / a, 1), 0) end as d1,
        case when least(a, b, c, d) = 0 then 0.5 else greatest(least(2 - 3 * y * c / b, 2), 0) end as d2,
        case when least(a, b, c, d) = 0 then 0.75 else greatest(least(3 - 4 * y * d / c, 3), 0) end as d3, ones, twos, more, total
        from (select *, cast(a as double) / (a + 2 * b) as y from (select count(*) filter (n = 1) as a,
        count(*) filter (n = 2) as b, count(*) filter (n = 3) as c, count(*) filter (n = 4) as d,
        count(*) filter (n = 1) as ones, count(*) filter (n = 2) as twos, count(*) filter (n >= 3) as more,
        coalesce(sum(n), 0) as total from {counts})))"""


def kneser_ney(texts: str) -> str:
    """Common table expressions from ``texts`` (key, text, train) to ``scored`` (key, tokens, known, base, score)."""
    return f"""
seq as (select key, train, list_concat({WORDS}, [' ']) as t from {texts}),
tok as (select key, train, unnest(t) as w, unnest(list_concat(['  '], t[:-2])) as c from seq),
uni as (select w, count(*) as n from tok where train group by w),
pair as (select c, w, count(*) as n from tok where train group by c, w),
ctx as (select c, sum(n) as total, count(*) filter (n = 1) as ones, count(*) filter (n = 2) as twos,
    count(*) filter (n >= 3) as more from pair group by c),
cont as (select w, count(*) as n from pair group by w),
pd as {_discounts('pair')}, wd as {_discounts('cont')},
all_words as (select coalesce(sum(n), 0) as tokens, count(*) as words from uni),
alone as (select tok.key, tok.c, tok.w, coalesce(uni.n, 0) as n, case when wd.total = 0 then 1 else
    (greatest(coalesce(cont.n, 0) - case coalesce(cont.n, 0) when 0 then 0 when 1 then d1 when 2 then d2 else d3 end, 0)
     + (d1 * ones + d2 * twos + d3 * more) / (words + 1)) / wd.total end as p,
    log10((coalesce(uni.n, 0) + 0.1) / (tokens + 0.1 * (words + 1))) as base
    from tok left join uni using (w) left join cont using (w) cross join wd cross join all_words),
scored as (select key, count(*) as tokens, count(*) filter (alone.n > 0) as known, sum(base) as base,
    sum(log10(case when ctx.total is null then p else (coalesce(pair.n - case pair.n when 1 then d1 when 2 then d2 else d3 end, 0)
        + (d1 * ctx.ones + d2 * ctx.twos + d3 * ctx.more) * p) / ctx.total end)) as score
    from alone left join ctx on alone.c = ctx.c left join pair on alone.c = pair.c and alone.w = pair.w cross join pd group by key)"""
