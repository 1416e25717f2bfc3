"""Language identification by Bayesian fusion of evidence.

For each row, log posterior of a language =
    log likelihood of the text          (byte trigrams, naive Bayes, tempered)
  + log P(declared language | language) (markup of the page)
  + log prior of the host               (smoothed towards domain, suffix, whole).

The languages are those of all labelled texts; the trigram table is fitted on an equal
share of ``SAMPLE`` texts of each (``LEAST`` at least, or all it has).  All else is
estimated from all rows by grouped aggregation of the text posteriors: a declared
language is trusted as far as it agrees with the texts that carry it, and the
language shares of each address suffix are smoothed towards the shares of the
whole, those of each domain towards its suffix, those of each host towards its
domain (``STRENGTH`` pseudo rows a level).  A row's own text is left out of its
priors, so it does not count twice.

Rows are read once for their text; groups of any size only meet as partial sums.

Edge cases: null and empty texts have no text evidence; rows without declaration
or address get no such evidence (their prior is that of the level that is known);
an unknown declared language is as good as its agreement with the texts; ties go
to the first language by name; repeated rows count as often as they occur; null
ids are kept; an empty table gives no rows; without labelled texts the language
is null.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import per_text, sample_of_each, small_batches, staged

SAMPLE = 4_000           # labelled texts, shared out to the languages
LEAST = 200              # of each language, if it has them
SLOTS = 1 << 16          # hashed byte trigrams
TEMPER = 0.2             # overlapping trigrams are not independent
STRENGTH = 5.0
_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible(page: str | None) -> str:
    """Text of a page without markup."""
    return html.unescape(_HIDDEN.sub(" ", page or ""))


def trigrams(text: str | None) -> np.ndarray:
    """Slots of the text's byte trigrams, lower-cased, white space and signs as one blank."""
    raw = re.sub(r"[\W\d_]+", " ", f" {(text or '').lower()} ").encode()
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, dtype=np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(16)


class Languages:
    """Log likelihoods of trigram slots by language."""

    def __init__(self, texts: Sequence[str | None], langs: Sequence[str], slots: int = SLOTS) -> None:
        self.names = sorted(set(langs))
        count = np.zeros((slots, len(self.names)))
        for text, lang in zip(texts, langs, strict=True):
            count[:, self.names.index(lang)] += np.bincount(trigrams(text), minlength=slots)
        self.logs = (np.log((count + 0.5) / (count.sum(axis=0) + 0.5 * slots))).astype(np.float32)

    def likelihood(self, text: str | None, temper: float = TEMPER) -> np.ndarray:
        """Tempered log likelihoods, the largest moved to 0."""
        x = self.logs[trigrams(text)].sum(axis=0, dtype=np.float64) * temper
        return x - x.max() if len(x) else x


def train(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE) -> Languages:
    """Fit the trigram table on the labelled texts of each language with the smallest hashes."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                                          F.col(lang_col).alias("lang"))
    some = sample_of_each(rows, lambda total: dict.fromkeys(total, max(LEAST, sample // len(total))), "lang", "id").toPandas()
    return Languages(some["text"].tolist(), some["lang"].tolist())


def likelihoods(languages: Languages, text: Column, markup: bool) -> Column:
    return per_text(lambda x: languages.likelihood(visible(x) if markup else x), "array<double>", text)


def declared_language(page: Column) -> Column:
    """Primary language tag of the html element, lower case; null if there is none."""
    got = F.lower(F.regexp_extract(page, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    return F.when(got != "", got)


def host_of(url: Column) -> Column:
    """Host of an address, lower case; null if there is none."""
    got = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(got != "", got)


def page_rows(pages: DataFrame, languages: Languages, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Evidence of web pages: ``(id, ll, declared, suffix, domain, host)``."""
    host = host_of(F.col(url_col))
    return (small_batches(pages).select(F.col(id_col).alias("id"), likelihoods(languages, F.col(html_col), True).alias("ll"),
                         declared_language(F.col(html_col)).alias("declared"), host.alias("host"))
            .select("id", "ll", "declared", F.substring_index("host", ".", -1).alias("suffix"),
                    F.substring_index("host", ".", -2).alias("domain"), "host"))


def text_rows(docs: DataFrame, languages: Languages, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """Evidence of plain texts: their source stands for the host."""
    none = F.lit(None).cast("string")
    return small_batches(docs).select(F.col(id_col).alias("id"), likelihoods(languages, F.col(text_col), False).alias("ll"),
                       none.alias("declared"), none.alias("suffix"), none.alias("domain"),
                       F.col(source_col).cast("string").alias("host"))


def fuse(rows: DataFrame, names: Sequence[str], strength: float = STRENGTH) -> DataFrame:
    """``(id, lang, confidence, text_lang, declared)`` from rows of evidence.

    ``rows`` is read several times; pass a written table.
    """
    k = range(len(names))
    if not names:
        none = F.lit(None).cast("string")
        return rows.select("id", none.alias("lang"), F.lit(None).cast("double").alias("confidence"), none.alias("text_lang"), "declared")

    def softmax(logs: list[Column]) -> list[Column]:
        top = F.greatest(*logs) if len(logs) > 1 else logs[0]
        e = [F.exp(x - top) for x in logs]
        total = sum(e[1:], e[0])
        return [x / total for x in e]

    rows = rows.select("*", *[p.alias(f"p{i}") for i, p in zip(k, softmax([F.get("ll", F.lit(i)) for i in k]), strict=True)])
    sums = [F.sum(f"p{i}") for i in k]

    def shares(by: str) -> DataFrame:
        # staged, so that a join of the rows with a frequent value can be split
        return staged(rows.where(F.col(by).isNotNull()).groupBy(by).agg(
            F.array(*sums).alias(f"{by}_n"), F.count(F.lit(1)).alias(f"{by}_k")), f"langid-{by}")

    whole = rows.agg(*[s.alias(f"s{i}") for i, s in zip(k, sums, strict=True)], F.count(F.lit(1)).alias("n")).first()
    whole_n = [float(whole[f"s{i}"] or 0) for i in k]
    joined = rows
    for by in ("declared", "suffix", "domain", "host"):
        joined = joined.join(shares(by), by, "left")
    # Priors level by level; own p_i and own row left out.
    prior = [(F.lit(whole_n[i]) - F.col(f"p{i}") + 1.0) / F.lit(float(whole["n"] - 1 + len(names))) for i in k]
    for by in ("suffix", "domain", "host"):
        prior = [F.when(F.col(f"{by}_k").isNull(), prior[i]).otherwise(
            (F.greatest(F.get(f"{by}_n", F.lit(i)) - F.col(f"p{i}"), F.lit(0.0)) + strength * prior[i])
            / (F.col(f"{by}_k") - 1 + strength)) for i in k]
        joined = joined.withColumns({f"{by}_p{i}": prior[i] for i in k})
        prior = [F.col(f"{by}_p{i}") for i in k]
    # P(declared | language), smoothed towards the declaration's share of all rows.
    said = []
    for i in k:
        share = F.col("declared_k") / F.lit(float(max(1, whole["n"])))
        own = F.greatest(F.get("declared_n", F.lit(i)) - F.col(f"p{i}"), F.lit(0.0))
        said.append(F.when(F.col("declared_k").isNull(), F.lit(0.0)).otherwise(
            F.log((own + strength * share) / (F.greatest(F.lit(whole_n[i]) - F.col(f"p{i}"), F.lit(0.0)) + strength))))
    post = softmax([F.get("ll", F.lit(i)) + F.log(prior[i]) + said[i] for i in k])
    out = joined.select("id", "declared", *[x.alias(f"q{i}") for i, x in zip(k, post, strict=True)], *[f"p{i}" for i in k])

    def best(c: str) -> Column:
        top = F.greatest(*[F.col(f"{c}{i}") for i in k]) if len(names) > 1 else F.col(f"{c}0")
        return F.coalesce(*[F.when(F.col(f"{c}{i}") == top, F.lit(names[i])) for i in k])
    top = F.greatest(*[F.col(f"q{i}") for i in k]) if len(names) > 1 else F.col("q0")
    return out.select("id", best("q").alias("lang"), top.alias("confidence"), best("p").alias("text_lang"), "declared")


def identify(rows: DataFrame, languages: Languages, strength: float = STRENGTH) -> DataFrame:
    """Write the evidence once, then ``fuse`` it."""
    return fuse(staged(rows, "langid"), languages.names, strength)
