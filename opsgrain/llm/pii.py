"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust their score.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of context on each side, and what a context word adds to or takes from the score.
CONTEXT, RAISE, LOWER = 40, 0.3, 0.3
#: Least score of a span of a kind that is not kept anyway.
LEAST = 0.5
#: Matches whose places are summed up at a time.
STRETCH = 512


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _between(number: Column, low: int, high: int) -> Column:
    return (number >= low) & (number <= high)


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?  Every second digit from the right is doubled, less 9 if over 9."""
    places = F.split(F.reverse(digits), "(?!^)(?!$)")
    twice = F.transform(places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 9 + F.when(d == "9", 9).otherwise(0)))
    return F.aggregate(twice, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """Does an IBAN (capitals and digits) leave 1 modulo 97, its first four places put last and A-Z read as 10-35?"""
    turned = F.split(F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4)), "(?!^)(?!$)")
    number = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(turned, F.lit(0), lambda a, c: F.when(number(c) > 9, a * 100 + number(c)).otherwise(a * 10 + number(c)) % 97) == 1


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``confirm`` decides; ``base`` spans stay whatever their score, others from ``LEAST`` on.

    ``needs`` is a cheap test of the whole text without which there is no span.  Patterns are written so that the Java
    matcher needs linear time and no recursion: a run of characters is entered at its start (or where the last match
    ended) and never given back.
    """

    name: str
    pattern: str
    needs: Callable[[Column], Column]
    confirm: Callable[[Column], Column]
    score: float
    base: bool
    raising: str = ""
    lowering: str = ""


#: Characters of an IBAN by country: the registry of ISO 13616, then countries that use the form without being in it.
IBAN_LENGTHS: dict[int, str] = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST AO CV GW MZ", 26: "IS TR DZ IR",
    27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """One alternative per length, compact or in groups of four, so that no word behind the number is taken."""
    rests = {n: r"\x20?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "" for n in IBAN_LENGTHS}
    forms = [r"(?:%s)[0-9]{2}(?:\x20?[A-Z0-9]{4}){%d}%s" % ("|".join(c.split()), n // 4 - 1, rests[n]) for n, c in IBAN_LENGTHS.items()]
    return r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:%s)(?![A-Za-z0-9])" % "|".join(forms)


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS: tuple[Kind, ...] = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        lambda h: F.lit(True),
        0.9, True, "e-?mail|contact|write to|mailto", "example|noreply|no-reply",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        lambda h: h.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        0.6, True, r"\bip\b|address|host|server|login", "version|release|build|section|chapter",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
        lambda h: _between(F.length(_digits(h)), 14, 19) & luhn(_digits(h)),
        0.7, True, "card|visa|mastercard|amex|credit|debit|payment", "order|serial|tracking|isbn",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        lambda h: _between(F.length(_digits(h)), 10, 15),
        0.6, True, r"phone|\btel|mobile|call|\bfax", "serial|version",
    ),
    Kind(
        "iban",
        _iban(),
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
        lambda h: _between(F.length(F.replace(h, F.lit(" "), F.lit(""))), 15, 34) & mod97(F.replace(h, F.lit(" "), F.lit(""))),
        0.8, False, "iban|account|bank|transfer", "serial|part number",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        lambda h: F.lit(True),
        0.3, False, r"\bssn\b|social security", "order|serial|part number",
    ),
)

_SPAN = "struct<start:bigint,place:int,kind:string,end:bigint,score:double,base:boolean>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: Column, pattern: str) -> Column:
    """The matches in order, each with the text before it: lengths, the match, and as much of both ends as a context can need.

    Behind them stands the text after the last match, as one more piece whose match is null.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def piece(pair: Column) -> Column:
        gap, hit = pair["gap"], F.coalesce(pair["hit"], F.lit(""))
        ends = {"gap_left": F.left(gap, F.lit(CONTEXT)), "gap_right": F.right(gap, F.lit(CONTEXT)), "hit_left": F.left(hit, F.lit(CONTEXT)), "hit_right": F.right(hit, F.lit(CONTEXT))}
        return F.struct(
            F.length(gap).cast("bigint").alias("gap"), F.length(hit).cast("bigint").alias("size"), pair["hit"].alias("hit"), *[c.alias(n) for n, c in ends.items()]
        )

    return F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), piece)


def _starts(pieces: Column) -> Column:
    """Where each piece begins, by running sums in stretches of ``STRETCH``: the lists that are added to stay short."""
    size, none = F.size(pieces), F.array().cast("array<bigint>")

    def running(sizes: Column, at: Column) -> Column:
        begin = F.struct(at.alias("at"), none.alias("starts"))
        step = lambda so_far, n: F.struct((so_far["at"] + n).alias("at"), F.concat(so_far["starts"], F.array(so_far["at"])).alias("starts"))
        return F.aggregate(sizes, begin, step, lambda end: end["starts"])

    def of(sizes: Column) -> Column:
        stretches = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / STRETCH).cast("int")), lambda k: F.slice(sizes, k * STRETCH + 1, F.lit(STRETCH)))

        def joined(parts: Column) -> Column:
            sums = F.transform(parts, lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda a, n: a + n))
            begins = running(sums, F.lit(0).cast("bigint"))
            return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), begins.alias("at")), lambda x: running(x["part"], x["at"])))

        return _let(stretches, joined)

    return _let(F.transform(pieces, lambda p: p["gap"] + p["size"]), of)


def _spans(text: Column, kind: Kind, place: int) -> Column:
    """Confirmed spans of a kind, in time that grows with the text: matches are found once, their places are running sums, and the
    context of a confirmed match comes from the pieces beside it, of which CONTEXT on each side always suffice, as no match is empty."""
    none = F.array().cast(f"array<{_SPAN}>")

    def found(pieces: Column, starts: Column) -> Column:
        numbered = F.transform(pieces, lambda p, i: F.struct(i.alias("i"), p["hit"].alias("hit")))
        sure = F.filter(numbered, lambda n: n["hit"].isNotNull() & kind.confirm(n["hit"]))

        def span(n: Column) -> Column:
            me = F.get(pieces, n["i"])
            before = F.slice(pieces, F.greatest(n["i"] - CONTEXT, F.lit(0)) + 1, F.least(n["i"], F.lit(CONTEXT)))
            behind = F.slice(pieces, n["i"] + 2, F.lit(CONTEXT))
            left = F.concat(F.array_join(F.transform(before, lambda p: F.concat(p["gap_right"], p["hit_right"])), ""), me["gap_right"])
            right = F.array_join(F.transform(behind, lambda p: F.concat(p["gap_left"], p["hit_left"])), "")
            near = F.lower(F.concat(F.right(left, F.lit(CONTEXT)), F.lit(" "), F.left(right, F.lit(CONTEXT))))
            begin = F.get(starts, n["i"]) + me["gap"]

            def scored(words: Column) -> Column:
                score = F.lit(kind.score)
                if kind.raising:
                    score = score + F.when(words.rlike(kind.raising), RAISE).otherwise(0.0)
                if kind.lowering:
                    score = score - F.when(words.rlike(kind.lowering), LOWER).otherwise(0.0)
                return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 3)

            return F.struct(
                begin.alias("start"), F.lit(place).alias("place"), F.lit(kind.name).alias("kind"), (begin + me["size"]).alias("end"),
                _let(near, scored).alias("score"), F.lit(kind.base).alias("base"),
            )

        spans = F.transform(sure, span).cast(f"array<{_SPAN}>")
        return spans if kind.base else F.filter(spans, lambda s: s["score"] >= LEAST)

    pieces = _pieces(text, kind.pattern)
    walked = _let(pieces, lambda p: _let(_starts(p), lambda s: found(p, s)))
    return F.when(kind.needs(text), F.coalesce(walked, none)).otherwise(none)


def find_personal_data(docs: DataFrame, kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """doc_id and ``spans`` of each row of ``docs`` (doc_id, text): array of (start, place, kind, end, score, base).

    Starts and ends are code points, the end exclusive; spans are sorted by start, then by the place of their kind.  Every text is
    read whole, matches of a kind do not overlap, and a proposed match that its check refuses is dropped without a retry.  The score
    of a kind is raised or lowered by words within ``CONTEXT`` code points before and behind it, other matches included.

    A null or empty text has no spans.  Repeated rows are judged alike; an empty table gives an empty result; other columns
    are not read.  One pass over each row, no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = [_spans(text, k, i) for i, k in enumerate(kinds)]
    return docs.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
