"""URL filter with a weighted vocabulary, and host and path rules that overrule it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

@dataclass(frozen=True)
class Term:
    """``weight`` 1 or more alone rejects a URL.  A ``whole`` term counts between places without letter or digit, another one also inside words."""

    text: str
    weight: float
    whole: bool = True

    @property
    def strict(self) -> bool:
        return self.weight >= REJECTED


#: Sum of the weights of distinct terms from which a URL is rejected.
REJECTED = 1.0


def terms(words: str, weight: float, whole: bool = True) -> tuple[Term, ...]:
    return tuple(Term(w, weight, whole) for w in words.split())


# Fixed values, a general vocabulary by kind of site.  It was written down for this library and holds no host of any table.  Everyday
# words are left out; words that are usual in some clean addresses are soft, and the softer the more so.
VOCABULARY: tuple[Term, ...] = (
    # unmistakable, also inside a longer word
    *terms("viagra cialis blackjack hentai keygen malware phishing pornhub ransomware warez", 1.0, whole=False),
    # adult sites, gambling, spam and malware
    *terms("casino casinos escort escorts gambling porn porno pornos sex sexcam sexcams spam spyware xxx", 1.0),
    # two of these
    *terms("adult adware bet bets betting camgirl camgirls cracked jackpot nude nudes payday pharmacy pills poker roulette slots torrent torrents", 0.5),
    # three of these
    *terms("ads adserver affiliate bonus clicks coupons crack dating discount loans lottery popunder popup promo serials tracker", 0.34),
)


@lru_cache(maxsize=8)
def _automaton(vocabulary: tuple[Term, ...]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term in vocabulary:
        machine.add_word(term.text, term)
    machine.make_automaton()
    return machine


def _inside(text: str, at: int) -> bool:
    """Is there an ASCII letter or digit at this place?"""
    return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def term_hits(url: str | None, vocabulary: tuple[Term, ...] = VOCABULARY) -> tuple[list[str], list[str], float]:
    """Distinct strict and soft terms in a URL, in order, and the sum of their weights."""
    text = _lower(url or "")
    found: set[Term] = set()
    if vocabulary:
        for end, term in _automaton(vocabulary).iter(text):
            if not term.whole or not _inside(text, end - len(term.text)) and not _inside(text, end + 1):
                found.add(term)
    return sorted(t.text for t in found if t.strict), sorted(t.text for t in found if not t.strict), math.fsum(t.weight for t in found)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host behind the first :// up to / ? # (A-Z lower-cased), then the path up to ? or #; both empty without :// or for null."""
    parts = "://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, parts, 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = (), vocabulary: Sequence[Term] = VOCABULARY) -> DataFrame:
    """page_id, host, path, rule, strict_terms, soft_terms, weight and verdict (allow or block) of each row of ``pages`` (page_id, url).

    An Aho-Corasick machine finds the terms of the vocabulary in the lower-cased URL in one pass; a whole term counts only at boundaries,
    and a term once however often it occurs.  Distinct terms whose weights reach ``REJECTED`` block: one strict one, or several soft ones.
    ``rules`` are (action,
    host + path) pairs, a configured list of moderate length: a rule fits its host and all subdomains where the path starts
    with the rule's; the longest that fits (the first of equal ones) decides instead of the terms.

    A null URL, or one without ://, has empty host and path and no terms of its own is found in a null one, so it is allowed.
    Repeated rows are judged alike; an empty table gives an empty result; other columns are not read.  No shuffle.
    """
    words = tuple(vocabulary)
    if len({t.text for t in words}) < len(words):
        raise ValueError("a term has one weight")

    @pandas_udf("strict_terms array<string>, soft_terms array<string>, weight double")
    def hits(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([term_hits(u, words) for u in urls], columns=["strict_terms", "soft_terms", "weight"])

    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", host.alias("host"), path.alias("path"), hits("url").alias("hits"))
    rule = action = F.lit(None).cast("string")
    for what, pattern in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first, so it comes last here
        at = pattern.index("/")
        own_host, own_path = pattern[:at], pattern[at:]
        fits = ((F.col("host") == own_host) | F.col("host").endswith("." + own_host)) & F.col("path").startswith(own_path)
        rule, action = F.when(fits, pattern).otherwise(rule), F.when(fits, what).otherwise(action)
    verdict = F.coalesce(action, F.when(F.col("hits.weight") >= REJECTED, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), "hits.strict_terms", "hits.soft_terms", "hits.weight", verdict.alias("verdict"))
