"""Language identification with the byte network of ``gru``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import gru

UNKNOWN = "und"
#: Bound of the training sample: at most so many documents, the same number of each language, and windows of each document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 4000, 3


def held_out() -> Column:
    """crc32(doc_id as text) mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(docs: DataFrame, docs_most: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS) -> list[tuple[bytes, str]]:
    """Windows and languages of a bounded sample of the labelled documents that are not held out.

    Of each language the documents with the smallest hash of the id, so many of each that all languages together stay within
    ``docs_most``; a document gives up to ``windows`` windows, at places that follow from the hash.  Only the cut windows are moved, and
    only of documents whose hash is below a bound that about twice the wanted number of a language reach, so what is moved
    depends on the sample and not on the table.  The counts that the bounds follow from have one row per language.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out() & has_letter(F.col("text")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    most = max(1, docs_most // len(counts))
    share = {x: min(1.0, (2 * most + 100) / n) for x, n in counts.items()}
    bounds = F.create_map(*[F.lit(v) for x in sorted(share) for v in (x, min(2**63 - 1, int(share[x] * 2**64) - 2**63))])
    raw, size = F.col("text").cast("binary"), F.octet_length("text")
    places = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.lit(1), size - gru.WINDOW + 1)) for k in range(windows)]
    cuts = F.array_distinct(F.array(*[F.substring(raw, (p + 1).cast("int"), F.lit(gru.WINDOW)) for p in places]))
    order = F.xxhash64("doc_id", "text")
    cut = labelled.filter(order <= F.element_at(bounds, F.col("lang"))).select("lang", order.alias("order"), cuts.alias("cuts"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    rows = cut.withColumn("rank", rank).filter(F.col("rank") <= most).select("lang", "order", "cuts").collect()
    return [(bytes(c), r.lang) for r in sorted(rows, key=lambda r: (r.lang, r.order)) for c in r.cuts]


def fit(docs: DataFrame, docs_most: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS) -> gru.Network | None:
    """The network of the labelled documents (doc_id, text, lang), or None if there are none.  Reruns give the same one."""
    rows = sample(docs, docs_most, windows)
    return gru.train([t for t, _ in rows], [x for _, x in rows]) if rows else None


def predict(text: Column, net: gru.Network | None) -> Column:
    """struct(lang_pred, score) of a text column: the language with the largest mean probability over all bytes of the text.

    A null text and one without a letter is ``und`` with score 0, as is every text without a network.  Equal probabilities: the
    first language by name.  Texts of any length are read whole, in windows, in bounded memory.
    """

    @pandas_udf("lang_pred string, score double")
    def labels(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = texts.notna().to_numpy()
            raw = [t.encode("utf-8", "surrogatepass") for t in texts[known]]
            chances = net.pooled(raw)
            best = chances.argmax(axis=1)
            names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            names[known] = np.array(net.labels, dtype=object)[best]
            scores[known] = np.clip(chances[np.arange(len(raw)), best], 0.0, 1.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    if net is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return labels(F.when(has_letter(text), text))


def _identified(docs: DataFrame, net: gru.Network | None, with_rows: bool) -> DataFrame:
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_rows else []
    out = docs.select(F.col("doc_id").alias("doc_id"), held_out().alias("held_out"), predict(F.col("text"), net).alias("found"), *whole)
    return out.select("doc_id", "held_out", "found.lang_pred", "found.score", *(["row"] if with_rows else []))


def identify(docs: DataFrame, docs_most: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS, with_rows: bool = True) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs`` (doc_id, text, lang and any others).

    The network is trained on the driver from a bounded sample (see ``sample``) and sent to the tasks; prediction reads the text alone, row
    by row, without a shuffle.  Documents with a null lang are predicted like any other; repeated rows get the same answer; an
    empty table gives an empty result.  ``with_rows`` adds the whole input row as the struct ``row``.
    """
    net = fit(docs.select("doc_id", "text", "lang"), docs_most, windows)
    return _identified(docs, net, with_rows)


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which a language can be told, with their columns; those with ``und`` go.  Where no row has a label to learn
    from, there is no network, and all rows with a letter stay."""
    net = fit(docs.select("doc_id", "text", "lang"))
    if net is None:
        return docs.filter(has_letter(F.col("text")))
    return _identified(docs, net, True).filter(F.col("lang_pred") != UNKNOWN).select("row.*")
