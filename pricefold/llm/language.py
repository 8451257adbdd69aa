"""Operator 3: language identification by Bayesian fusion of text, declared language, address suffix and host.

The posterior of a language is the product of

- the likelihood of the text under a trigram model of the language,
- the probability that a document of the language declares what this one declares, and
- the prior of its host, which is smoothed towards that of its address suffix, which is smoothed towards that of all
  documents. A document's own declaration is left out of the counts behind its prior.

One more class, for text in none of the languages, draws each letter by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.llm.common import checkpointed, drawn
from pricefold.llm.pieces import forget_kept

LANGUAGES = ("de", "en", "es", "fr")
TRAIN_ROWS = 8_000
# Signs: 0 for all but letters, then a-z, then other letters by code point, several to a class.
_SIGNS = 64
_FEW_HOSTS = 100_000
_STRETCH = 1 << 20
_NO_WORD = re.compile(r"[0-9@]")


def _sign_table() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        sign = chr(code)
        if "a" <= sign <= "z":
            table[code] = code - 96
        elif code > 127 and sign.isalpha():
            table[code] = 27 + code % (_SIGNS - 27)
    return table


_TABLE = _sign_table()


def trigrams(text: str) -> Iterator[np.ndarray]:
    """The trigrams of a text that have a letter, as numbers, a stretch at a time.

    Words with a digit or an at sign, such as addresses and keys, are in no language and left out.
    """
    if _NO_WORD.search(text):
        text = " ".join(word for word in text.split() if not _NO_WORD.search(word))
    for start in range(0, max(len(text) - 2, 0), _STRETCH):
        codes = np.frombuffer(text[start : start + _STRETCH + 2].lower().encode("utf-32-le", "replace"), "<u4")
        signs = _TABLE[np.minimum(codes, 0xFFFF)].astype(np.int32)
        found = (signs[:-2] * _SIGNS + signs[1:-1]) * _SIGNS + signs[2:]
        yield found[found > 0]


def trained(docs: DataFrame, languages: Sequence[str], rows: int) -> np.ndarray:
    """Log-likelihood of each trigram's last sign under each language, and under none of them, as one table.

    Counted over about ``rows`` of the distinct texts that declare one of the languages. ``docs`` has text and declared.
    """
    labelled = docs.where(F.col("declared").isin(*languages) & F.col("text").isNotNull()).select("declared", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        seen = np.zeros((len(languages), _SIGNS**3), np.int64)
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for found in trigrams(text.as_py()):
                    np.add.at(seen[languages.index(language)], found, 1)
        language, trigram = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({
            "language": pa.array(language, pa.int32()), "trigram": pa.array(trigram, pa.int32()),
            "n": pa.array(seen[language, trigram], pa.int64()),
        })

    counted = drawn(labelled, rows).mapInArrow(count, "language int, trigram int, n long").groupBy("language", "trigram").agg(F.sum("n"))
    counts = np.zeros((len(languages), _SIGNS, _SIGNS, _SIGNS))
    # At most one row for each language and trigram.
    for language, trigram, n in counted.collect():
        counts[language].reshape(-1)[trigram] = n
    letters = counts.sum(axis=(0, 1, 2)) + 1.0
    letters /= letters.sum()
    # Ten more occurrences of each beginning, dealt out by how frequent the signs are.
    likely = np.log((counts + 10 * letters) / (counts.sum(axis=3, keepdims=True) + 10))
    unlike = np.broadcast_to(np.log(letters), (1, _SIGNS, _SIGNS, _SIGNS))
    table = np.concatenate([likely, unlike]).reshape(len(languages) + 1, -1)
    return np.ascontiguousarray(table.T.astype(np.float32))


def _mixed(counts: np.ndarray, above: np.ndarray, weight: float) -> np.ndarray:
    """Shares by counts, with ``weight`` more cases shared out as above."""
    return (counts + weight * above) / (counts.sum(axis=1, keepdims=True) + weight)


def identified(
    docs: DataFrame,
    languages: Sequence[str] = LANGUAGES,
    text: str = "text",
    declared: str | None = "lang",
    host: str | None = "source",
    suffix: str | None = None,
    train_rows: int = TRAIN_ROWS,
    evidence: int = 64,
    reliable: float = 0.9,
    unknown: float = 0.01,
    smoothing: float = 20.0,
    sure: float = 0.5,
    into: str = "identified",
) -> DataFrame:
    """``docs`` with a struct column ``into``: language, confidence (its posterior), kept.

    ``evidence`` bounds for how many independent trigrams a text counts, since its trigrams are not independent;
    ``reliable`` is the probability that a declaration is true, ``unknown`` the prior of no language and ``smoothing`` the
    number of cases that a prior takes over from the level above. A document is kept if its best class is a language
    with a posterior of at least ``sure``. A null text, an empty one and one without letters have no language and are
    not kept. A null declaration, one of another language, a null host and a null suffix say nothing or form a group
    of their own. A column of ``docs`` that is called ``into`` is replaced; other columns, whatever their names, pass
    through, as do repeated rows.

    The trigram table is fitted on a bounded sample of about ``train_rows`` labelled, distinct texts. The counts behind the priors
    cover all documents; they are one row per host, broadcast only if there are few, and else joined by host.
    """
    languages = list(languages)
    docs = docs.drop(into)

    def named(column: str | None) -> F.Column:
        return F.lit(None).cast("string") if column is None else F.col(column).cast("string")

    table = trained(docs.select(F.col(text).alias("text"), named(declared).alias("declared")), languages, train_rows)

    told = docs.select(named(host).alias("_host"), named(suffix).alias("_suffix"), named(declared).alias("_declared"))
    counts = [F.count_if(F.col("_declared") == language).alias(f"_n{place}") for place, language in enumerate(languages)]
    hosts = checkpointed(told.groupBy("_host", "_suffix").agg(*counts))
    sums = [F.sum(f"_n{place}").alias(f"_s{place}") for place in range(len(languages))]
    suffixes = hosts.groupBy(F.col("_suffix").alias("_of")).agg(*sums)
    whole = np.array([value or 0 for value in hosts.agg(*sums).first()], float)
    both = hosts.join(suffixes, F.col("_suffix").eqNullSafe(F.col("_of")))
    numbers = [F.array(*[f"_{kind}{place}" for place in range(len(languages))]).cast("array<double>") for kind in "ns"]
    known = both.select(
        F.col("_host").alias("_llm_h"), F.col("_suffix").alias("_llm_s"), F.struct(*numbers).alias("_llm_counts")
    )
    if hosts.count() <= _FEW_HOSTS:
        known = F.broadcast(known)
    # The document travels as one column, so no name in it clashes.
    whole_rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"), F.col(text).alias("text"),
        named(declared).alias("declared"), named(host).alias("host"), named(suffix).alias("suffix"),
    )
    same = F.col("host").eqNullSafe(F.col("_llm_h")) & F.col("suffix").eqNullSafe(F.col("_llm_s"))
    rows = whole_rows.join(known, same).select(
        F.col("_llm_counts.col1").alias("at_host"), F.col("_llm_counts.col2").alias("at_suffix"), "declared", "text", "doc"
    )
    classes, names = len(languages) + 1, docs.columns

    def log_text(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        totals, seen = np.zeros((len(batch), classes)), np.zeros(len(batch))
        for row, value in enumerate(batch):
            for found in trigrams(value.as_py() or ""):
                totals[row] += table[found].sum(axis=0, dtype=np.float64)
                seen[row] += len(found)
        weight = np.minimum(1.0, evidence / np.maximum(seen, 1))
        return totals * weight[:, None], seen

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            if not batch.num_rows:
                continue
            at_host, at_suffix = (
                batch.column(place).flatten().to_numpy(zero_copy_only=False).reshape(-1, classes - 1) for place in (0, 1)
            )
            itself = np.array([[name == language for language in languages] for name in batch.column(2).to_pylist()], float)
            even = np.full((1, classes - 1), 1.0 / (classes - 1))
            everywhere = _mixed(np.maximum(whole - itself, 0), even, smoothing)
            by_suffix = _mixed(np.maximum(at_suffix - itself, 0), everywhere, smoothing)
            by_host = _mixed(np.maximum(at_host - itself, 0), by_suffix, smoothing)
            prior = np.concatenate([by_host * (1 - unknown), np.full((len(itself), 1), unknown)], axis=1)
            says = np.where(itself > 0, reliable, (1 - reliable) / max(1, classes - 2))
            says = np.concatenate([says, np.full((len(itself), 1), 1.0 / (classes - 1))], axis=1)
            says[itself.sum(axis=1) == 0] = 1.0
            by_text, seen = log_text(batch.column(3))
            total = by_text + np.log(prior) + np.log(says)
            total -= total.max(axis=1, keepdims=True)
            share = np.exp(total)
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            sharest = share[np.arange(len(best)), best]
            found = (best < classes - 1) & (seen > 0)
            language = pa.array([languages[at] if there else None for at, there in zip(best.tolist(), found.tolist())], pa.string())
            told = pa.StructArray.from_arrays(
                [language, pa.array(sharest), pa.array(found & (sharest >= sure))], names=["language", "confidence", "kept"]
            )
            doc = batch.column(4)
            yield pa.RecordBatch.from_arrays([*doc.flatten(), told], names=[*names, into])

    answer = T.StructType.fromDDL("language string, confidence double, kept boolean")
    return rows.mapInArrow(fuse, T.StructType([*docs.schema.fields, T.StructField(into, answer)]))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages with what ``identified`` takes: text (without tags), declared, host, suffix; null where there is none.

    A comment, script or style that is not closed goes on to the end of the page; a tag that is not closed is text. Each
    pattern passes over a page once, however long it is and whatever is left open in it.
    """
    html = F.regexp_replace("html", r"(?is)<(script|style)\b.*?(?:</\1>|\z)|<!--.*?(?:-->|\z)", " ")
    # Up to the last sign that closes a tag, every tag is closed.
    closed = F.regexp_extract(html, r"(?s)^(.*>)", 1)
    rest = F.substr(html, F.length(closed) + 1)
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    lang = F.regexp_extract("html", r"(?is)<html\b[^<>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return pages.select(
        "page_id", F.concat(F.regexp_replace(closed, r"<[^>]*>", " "), rest).alias("text"), F.nullif(F.lower(lang), F.lit("")).alias("declared"),
        host.alias("host"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
    )
