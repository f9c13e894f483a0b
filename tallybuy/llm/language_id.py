"""Language of documents by Bayesian fusion of the text, a declared language, the address and its host."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybuy.llm.common import reuse_freed_memory, text_of
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

#: Byte trigrams are hashed into so many cells, and one more that says nothing.
_CELLS = 1 << 16
#: Each byte is in three trigrams, so their likelihoods count a third.
_TEMPER = 1 / 3
#: The class of texts that no language explains: all trigrams alike.
UNDETERMINED = "und"
_GROUP_BYTES = 1 << 19
#: Bytes that words consist of: a-z, apostrophe, blank, and all of other alphabets.
_LETTERED = np.zeros(256, bool)
_LETTERED[[*range(0x61, 0x7B), 0x20, 0x27, *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class LanguageModel:
    """``languages``, their shares, and ``weights[cell, language]``: log-likelihoods of trigrams, the last for ``und``.

    ``labelled`` is False where no row had a label, so nothing is known of any language.
    """

    languages: tuple[str, ...]
    shares: tuple[float, ...]
    weights: np.ndarray
    labelled: bool = True


def _codes(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Cell of the trigram from each byte on.

    The last two bytes of a text have none, nor have trigrams with a digit or
    sign in them: numbers and marks are of no language.
    """
    raw = np.frombuffer(data, np.uint8)
    b = raw.astype(np.uint32)
    code = b * np.uint32(0x9E3779B1)
    code[:-1] += b[1:] * np.uint32(0x85EBCA77)
    code[:-2] += b[2:] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    code >>= np.uint32(16)
    lettered = _LETTERED[raw]
    lettered[:-1] &= lettered[1:]
    lettered[:-1] &= lettered[1:]
    code[~lettered] = _CELLS
    for k in (1, 2):
        at = ends - k
        code[at[at >= 0]] = _CELLS
    return code


def _grouped(texts: list[str]):
    """Lower-cased bytes of some texts at a time, with the end of each."""
    group, size = [], 0
    for k, text in enumerate(texts):
        group.append(text.encode().lower())
        size += len(group[-1])
        if size >= _GROUP_BYTES or k == len(texts) - 1:
            yield b"".join(group), np.cumsum([len(x) for x in group])
            group, size = [], 0


def _text_scores(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Log-likelihood of each text in each language."""
    out = []
    for data, ends in _grouped(texts):
        starts = np.concatenate([[0], ends[:-1]])
        scores = np.zeros((len(ends), weights.shape[1]))
        full = np.flatnonzero(ends > starts)
        if len(full):
            scores[full] = np.add.reduceat(weights[_codes(data, ends)], starts[full], axis=0, dtype=np.float64)
        out.append(scores)
    return np.concatenate(out) if out else np.zeros((0, weights.shape[1]))


def fit_language_model(
    docs: DataFrame, label: str = "lang", per_language: int = 3000, least_rows: int = 1
) -> LanguageModel:
    """Fit trigram likelihoods on about ``per_language`` labelled rows of each language.

    Every label in lower case is a language, on however few rows; null, empty
    and ``und`` are no label. Labels on fewer than ``least_rows`` rows can be
    left out. The share of a language is counted over all rows. Rows are chosen
    by a hash of text and label; the trigrams of each task are added up before
    they are shuffled, and only the cells of the model reach the driver.
    """
    rows = docs.select(F.lower(F.col(label).cast("string")).alias("label"), text_of().alias("text"))
    rows = rows.where(~F.col("label").isin("", UNDETERMINED))
    found = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counts = {name: n for name, n in found.items() if n >= least_rows}
    names = sorted(counts)
    if not names:
        return LanguageModel((), (), np.zeros((_CELLS + 1, 1), np.float32), bool(found))
    share = F.coalesce(*[F.when(F.col("label") == n, min(1.0, per_language / counts[n])) for n in names])
    chosen = rows.where(F.pmod(F.xxhash64("text", "label"), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches):
        total = np.zeros((len(names), _CELLS + 1), np.int64)
        place = {n: k for k, n in enumerate(names)}
        for batch in batches:
            labels, texts = batch["label"].to_pylist(), batch["text"].to_pylist()
            for name in set(labels):
                for data, ends in _grouped([t for t, x in zip(texts, labels) if x == name]):
                    if data:
                        total[place[name]] += np.bincount(_codes(data, ends), minlength=_CELLS + 1)
        k, cell = np.nonzero(total[:, :_CELLS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(cell, pa.int32()), pa.array(total[k, cell], pa.int64())], names=["k", "cell", "n"]
        )

    grams = chosen.mapInArrow(count, "k int, cell int, n bigint").groupBy("k", "cell").agg(F.sum("n").alias("n"))
    table = np.full((_CELLS, len(names)), 0.5)
    found = grams.toPandas()  # at most a row for each cell and language
    table[found["cell"], found["k"]] += found["n"]
    logs = np.log(table / table.sum(0))
    # Against the mean over languages nothing changes; against "und" the level matters.
    weights = np.zeros((_CELLS + 1, len(names) + 1), np.float32)
    weights[:_CELLS, :-1] = logs
    weights[:_CELLS, -1] = -np.log(_CELLS)
    total = sum(counts.values())
    return LanguageModel(tuple(names), tuple(counts[n] / total for n in names), weights)


def suffix_of(host: Column) -> Column:
    """The last label of a host name; null if it has only one."""
    return F.when(F.instr(host, ".") > 0, F.lower(F.substring_index(host, ".", -1)))


def page_evidence(pages: DataFrame) -> DataFrame:
    """``doc_id, text, declared, host`` of raw pages: visible text, the language of the markup, the host."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1))
    return pages.select(
        F.col("page_id").alias("doc_id"),
        text.alias("text"),
        F.when(declared != "", declared).alias("declared"),
        F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)).alias("host"),
    )


def _counts_by(rows: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """Declared languages of each key, as an array of counts; one row for each key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(*[F.count(F.when(F.col("_declared") == n, 1)).cast("double") for n in names]).alias(f"_n_{key[1:]}")
    )


def identify(
    docs: DataFrame,
    model: LanguageModel,
    declared: str | None = "lang",
    host: str | None = "source",
    trust: float = 0.9,
    suffix_weight: float = 20.0,
    host_weight: float = 10.0,
    least: float = 0.5,
) -> DataFrame:
    """All columns of ``docs`` with ``language, confidence, accepted``.

    The posterior of a language is a product of three parts. The prior of its
    host: declared languages of the host's other rows, smoothed by those of its
    address suffix, and these by the shares in the whole corpus; ``*_weight`` are
    the rows that the coarser level counts as. The declared language is right
    with probability ``trust``, any other is equally likely. The text has its
    trigram likelihood, tempered because trigrams overlap. ``und`` stands for
    texts that are no language, with a prior of one row in a hundred.

    A row is accepted if its best class is a language with a posterior of at
    least ``least``. Missing evidence (null, empty, unknown) leaves the other
    parts to decide; where none speaks the shares of the corpus do. With a model
    of no labels at all every row is ``und`` and accepted: nothing speaks against
    any. ``declared``
    and ``host`` name columns, None for no such evidence. Repeated rows are scored
    alike. Columns of ``docs`` named like the new ones are replaced; all others, whatever their
    names, come through as they are. An empty table gives no rows.
    """
    names = model.languages
    kept = [c for c in docs.columns if c not in ("language", "confidence", "accepted")]
    if not names:
        return docs.select(*[F.col(f"`{c}`") for c in kept]).select(
            "*", F.lit(UNDETERMINED).alias("language"), F.lit(1.0).alias("confidence"), F.lit(not model.labelled).alias("accepted")
        )
    known = F.lower(F.col(f"`{declared}`").cast("string")) if declared else F.lit(None).cast("string")
    address = F.lower(F.col(f"`{host}`").cast("string")) if host else F.lit(None).cast("string")
    # The columns of `docs` go along in one, so that none can clash with those below.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        text_of().alias("_text"),
        F.when(known.isin(*names), known).alias("_declared"),
        F.when(address != "", address).alias("_host"),
    ).withColumn("_suffix", suffix_of(F.col("_host")))
    narrow = rows.select("_declared", "_host", "_suffix")
    hosts = write_out(_counts_by(narrow, "_host", names), "host-languages")
    suffixes = write_out(_counts_by(narrow, "_suffix", names), "suffix-languages")
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    def score(batches):
        reuse_freed_memory()
        for batch in batches:
            row = batch["_row"]
            texts = [t or "" for t in (row.field("text") if plain else batch["_text"]).to_pylist()]
            scores = _text_scores(texts, weights.value) * _TEMPER
            flat = pa.array(scores.reshape(-1), pa.float64())
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, scores.shape[1], dtype=np.int32), flat)
            rest = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), lists], names=[*rest, "_text"])

    # A text that is a string already goes to the workers once, with its row.
    plain = dict(docs.dtypes)["text"] == "string"
    rows = rows.drop("_text") if plain else rows
    schema = T.StructType([*(f for f in rows.schema if f.name != "_text"), T.StructField("_text", T.ArrayType(T.DoubleType()))])
    scored = rows.mapInArrow(score, schema)
    placed = lookup(lookup(scored, hosts, ["_host"]), suffixes, ["_suffix"])

    def smoothed(counts: str, own: int, before: Column, weight: float) -> Column:
        """Share of a language among the other rows of a host or suffix."""
        mine = F.when(F.col("_declared") == names[own], 1.0).otherwise(0.0)
        total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x) - F.when(F.col("_declared").isNotNull(), 1.0).otherwise(0.0)
        share = (F.get(counts, F.lit(own)) - mine + weight * before) / (total + weight)
        return F.coalesce(share, before)

    def log_posterior(k: int) -> Column:
        prior = smoothed("_n_host", k, smoothed("_n_suffix", k, F.lit(model.shares[k]), suffix_weight), host_weight)
        said = F.when(F.col("_declared").isNull(), 0.0)
        said = said.when(F.col("_declared") == names[k], F.lit(float(np.log(trust))))
        said = said.otherwise(float(np.log((1 - trust) / max(1, len(names) - 1))))
        return F.log(0.99 * prior + 1e-9) + said + F.get("_text", F.lit(k))

    undetermined = F.log(F.lit(0.01)) + F.get("_text", F.lit(len(names))) + F.when(
        F.col("_declared").isNull(), 0.0
    ).otherwise(float(np.log(1 / len(names))))
    logs = F.array(*[log_posterior(k) for k in range(len(names))], undetermined)
    best = placed.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    names_of = F.array(*[F.lit(n) for n in (*names, UNDETERMINED)])
    found = best.select(
        "_row",
        F.get(names_of, F.array_position("_logs", F.col("_top")).cast("int") - 1).alias("_language"),
        (1 / F.aggregate("_logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("_top")))).alias("_confidence"),
    )
    result = F.struct(
        F.col("_language").alias("language"),
        F.col("_confidence").alias("confidence"),
        ((F.col("_language") != UNDETERMINED) & (F.col("_confidence") >= least)).alias("accepted"),
    )
    return found.select("_row", result.alias("_result")).select("_row.*", "_result.*")
