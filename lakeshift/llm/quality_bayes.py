"""Quality classifier with hierarchical empirical Bayes.

1. Evidence of the document.  From labelled rows, words and word shapes whose
   presence separates good from bad documents are selected by grouped counts,
   and a sparse logistic regression is fitted on them (one for ``toxic``, one
   for low ``quality``).
2. Sites.  The documents' probabilities are summed by host and by path in one
   grouped aggregation.  Hosts have a Beta prior around the global mean whose
   strength comes from the spread between hosts (method of moments); paths
   shrink towards their host in the same way, so a site of few documents says
   little beyond its host, and a host of few documents little beyond the rest.
3. Posterior.  A document's log odds are shifted by the log odds of its path's
   posterior mean against the global mean.

The labelled sample is bounded: at most ``LABELLED`` rows, chosen by a hash of
``doc_id`` (documented limit; the selected words and the fit are small).  The
site statistics and the scores cover all documents.

Defined cases: a null text counts as empty; a null host or path is a site of
its own; labels with a null id or value are not used, of several texts of a labelled id
one is learned from; several labels of one
document count as its worst; without any labels every probability is the
prior of 1/2 and nothing is rejected; rows repeated with one id are scored
each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.llm import textnum
from lakeshift.llm.common import stored, temporary, unpacked
from lakeshift.llm.rows import positioned, without
from lakeshift.session import ship_package

#: Labelled rows used at most (about).
LABELLED = 20_000
#: A feature is looked at if it is in so many documents of a class, and so many standard errors apart.
LEAST_DOCS, LEAST_Z = 5, 5.0
#: Features that enter the regression at most, the most separating first.
SELECTED = 2_000
#: Weight of the sum of absolute weights in the regression.
PENALTY = 1e-4
#: Sites up to this many (about 100 bytes each) are broadcast, else shuffled.
BROADCAST_SITES = 20_000
#: Bytes of the word beginnings that are features.
PREFIXES = (4, 5, 6, 7, 8)
TARGETS = ("toxic", "low")


def _shares(rows: np.ndarray, n: int, marked: np.ndarray, kind: int) -> np.ndarray:
    """A feature for each row: which tenth (or its first half) the share of ``marked`` among the row's words falls into."""
    words = np.maximum(np.bincount(rows, minlength=n), 1)
    share = np.bincount(rows, marked, n) / words
    return textnum.mixed(np.ceil(share * 20).astype(np.uint64) + np.uint64(1000 * kind))


def source_site() -> tuple[Column, Column]:
    """Host and path of a row of ``documents``: its source, and its language within the source."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, rows, feature hashes): every text's words, word beginnings, word shapes and shares.

    Features of a text may come more than once.  The shares are those of words
    that repeat the word before, hold capitals beyond the first letter, and
    end in a symbol.
    """
    for a, b, data, offsets in textnum.slices(texts):
        starts, ends, rows = textnum.words(data, offsets, textnum.PLAIN)
        words = textnum.word_hashes(data, starts, ends)
        found = [(rows, words)]
        for n in PREFIXES:
            long = ends - starts > n
            found.append((rows[long], textnum.mixed(textnum.word_hashes(data, starts[long], starts[long] + n) ^ np.uint64(0xBE61))))
        s, e, spaced = textnum.words(data, offsets)
        shapes = textnum.shape_hashes(data, s, e)
        found.append((spaced, textnum.mixed(shapes ^ np.uint64(0x5AFE))))
        whole = textnum.word_hashes(data, s, e)
        again = np.zeros(len(s), bool)
        again[1:] = (whole[1:] == whole[:-1]) & (spaced[1:] == spaced[:-1])
        second = data[np.minimum(s + 1, e - 1)]
        capitals = (e - s > 1) & (second >= 65) & (second <= 90)
        symbol = ~textnum.PLAIN[data[e - 1]] & ~np.isin(data[e - 1], list(b".,;:"))
        each = np.arange(b - a)
        found += [(each, _shares(spaced, b - a, m, k + 1)) for k, m in enumerate((again, capitals, symbol))]
        yield a, b, *(np.concatenate(x) for x in zip(*found, strict=True))


def _present(rows: np.ndarray, hash_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hash_, rows))
    rows, hash_ = rows[order], hash_[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (hash_[1:] != hash_[:-1])]) if len(rows) else np.zeros(0, bool)
    return rows[new], hash_[new]


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = [batch.column(t).to_numpy(zero_copy_only=False).astype(bool) for t in TARGETS]
        for a, _, rows, hash_ in features(batch.column("text")):
            rows, hash_ = _present(rows, hash_)
            each, which = np.unique(hash_, return_inverse=True)
            counts = [np.bincount(which, minlength=len(each))] + [np.bincount(which, v[a + rows], len(each)) for v in y]
            yield pa.RecordBatch.from_arrays(
                [pa.array(each.view(np.int64))] + [pa.array(c.astype(np.int64)) for c in counts], ["feature", "n", *TARGETS]
            )


def _labelled_features(selected):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = selected.value
        for batch in batches:
            for a, b, rows, hash_ in features(batch.column("text")):
                at = np.minimum(np.searchsorted(known, hash_), max(len(known) - 1, 0))
                hit = known[at] == hash_ if len(known) else np.zeros(len(hash_), bool)
                rows, at = _present(rows[hit], at[hit].astype(np.uint64))
                cuts = np.searchsorted(rows, np.arange(b - a + 1))
                found = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(t).slice(a, b - a) for t in TARGETS] + [found], [*TARGETS, "found"])

    return run


def sparse_logistic(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, n_columns: int, penalty: float = PENALTY, steps: int = 500):
    """Weights and intercept of an L1-penalised logistic regression on presence features (accelerated proximal gradient)."""
    n = len(y)
    if not n or y.min() == y.max():
        p = (y.sum() + 0.5) / (n + 1)
        return np.zeros(n_columns), float(np.log(p / (1 - p))) if n else 0.0
    per_row = np.bincount(rows, minlength=n) + 1
    rate = 4.0 / max(1.0, np.mean(per_row) * 1.5)
    w = v = np.zeros(n_columns)
    c = cv = float(np.log(y.mean() / (1 - y.mean())))
    loss_at = lambda w, c: np.logaddexp(0, z := np.bincount(rows, w[columns], n) + c).mean() - (y * z).mean() + penalty * np.abs(w).sum()
    best, t = loss_at(w, c), 1.0
    for _ in range(steps):
        z = np.bincount(rows, v[columns], n) + cv
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        gw, gc = np.bincount(columns, g[rows], n_columns) / n, g.mean()
        new = v - rate * gw
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_c = cv - rate * gc
        loss = loss_at(new, new_c)
        if loss > best + 1e-12:  # overshot: restart the momentum with a smaller step
            rate, v, cv, t = rate * 0.5, w, c, 1.0
            continue
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, cv = new + (t - 1) / t2 * (new - w), new_c + (t - 1) / t2 * (new_c - c)
        w, c, best, t = new, new_c, loss, t2
    return w, float(c)


def labelled_sample(labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """(doc_id, toxic, low): at most about ``bound`` labelled documents, chosen by a hash of the id."""
    each = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") != 0).alias("toxic"), (F.col("quality") == 0).alias("low"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.max("low").alias("low"))
    )
    n = each.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return each if n <= bound else each.filter(share < bound / n)


class Model:
    """Feature hashes (sorted), their weights per target and the intercepts."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, intercepts: list[float]):
        self.known, self.weights, self.intercepts = known, weights, intercepts

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        out = np.tile(np.array(self.intercepts), (len(texts), 1))
        for a, b, rows, hash_ in features(texts):
            if not len(self.known):
                continue
            at = np.minimum(np.searchsorted(self.known, hash_), len(self.known) - 1)
            hit = self.known[at] == hash_
            rows, at = _present(rows[hit], at[hit].astype(np.uint64))
            for k in range(len(TARGETS)):
                out[a:b, k] += np.bincount(rows, self.weights[at.astype(np.int64), k], b - a)
        return out


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    """Select features and fit the regressions on the labelled sample."""
    spark = docs.sparkSession
    ship_package(spark)
    sample = labelled_sample(labels, bound)
    # One text a labelled id, so that the sample is bounded in rows too: of several that of the smallest digest.
    text = F.col("text").cast("string")
    train = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", *TARGETS)
        .agg(F.min_by("text", F.coalesce(F.sha2("text", 256), F.lit(""))).alias("text"))
        .select("text", *TARGETS),
        "quality-train",
    )
    size = train.agg(F.count("*").alias("n"), *[F.count_if(t).alias(t) for t in TARGETS]).first()
    counts = train.mapInArrow(_feature_counts, "feature long, n long, toxic long, low long").groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in ("n", *TARGETS)]
    )

    def z(t: str) -> Column:
        n1, n0 = F.lit(float(max(size[t], 1))), F.lit(float(max(size.n - size[t], 1)))
        p1, p0, p = F.col(t) / n1, (F.col("n") - F.col(t)) / n0, F.col("n") / F.lit(float(max(size.n, 1)))
        error = F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
        return F.when((F.col("n") >= LEAST_DOCS) & (error > 0), F.abs(p1 - p0) / error).otherwise(F.lit(0.0))

    best = counts.withColumn("z", F.greatest(*[z(t) for t in TARGETS])).filter(F.col("z") >= LEAST_Z)
    chosen = best.orderBy(F.desc("z"), "feature").limit(SELECTED).select("feature").toPandas()
    known = np.sort(chosen["feature"].to_numpy(np.int64).view(np.uint64))
    found = train.mapInArrow(_labelled_features(spark.sparkContext.broadcast(known)), "toxic boolean, low boolean, found array<int>").toPandas()
    lists = found["found"].tolist()
    rows = np.repeat(np.arange(len(found)), [len(x) for x in lists])
    columns = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(rows) else np.zeros(0, np.int64)
    fits = [sparse_logistic(rows, columns, found[t].to_numpy(bool).astype(float), len(known)) for t in TARGETS]
    weights = np.stack([w for w, _ in fits], 1) if len(known) else np.zeros((0, len(TARGETS)))
    used = np.abs(weights).sum(1) > 0
    return Model(known[used], weights[used], [c for _, c in fits])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = model.value.log_odds(batch.column("text"))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names if n != "text"] + [pa.array(odds[:, k]) for k in range(len(TARGETS))],
                [n for n in names if n != "text"] + [f"{t}_odds" for t in TARGETS],
            )

    return run


def _p(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, target: str, mean: str) -> float:
    """Strength of the Beta prior of groups (n, target's sum) around ``mean``, by the method of moments."""
    rate = F.col(target) / F.col("n")
    noise = F.sum(F.col(mean) * (1 - F.col(mean))).alias("noise")
    spread = F.sum(F.col("n") * (rate - F.col(mean)) ** 2).alias("spread")
    got = groups.agg(noise, spread, F.sum(F.col("n").cast("double")).alias("n"), F.count("*").alias("groups"),
                     F.sum(F.col(mean) * (1 - F.col(mean)) * F.col("n")).alias("unit")).first()
    if not got.n or got.spread is None:
        return 1.0
    between = max(got.spread - got.noise, 0.0)
    return float(np.clip(got.unit / between, 10.0, 1e6)) if between > 0 else 1e6


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, n, and for every target global, host and path means) for all sites of ``scored``."""
    sums = [F.sum(_p(F.col(f"{t}_odds"))).alias(t) for t in TARGETS]
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *sums), "quality-paths")
    total = paths.agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS])
    for t in TARGETS:
        mean = min(max((total[t] or 0.0) / max(total.n or 0, 1), 1e-6), 1 - 1e-6)
        hosts = hosts.withColumn(f"{t}_global", F.lit(mean))
        k = _strength(hosts, t, f"{t}_global")
        hosts = hosts.withColumn(f"{t}_host", (F.col(t) + k * F.lit(mean)) / (F.col("n") + k))
    hosts = hosts.select(F.col("host").alias("of_host"), *[f"{t}_{level}" for t in TARGETS for level in ("global", "host")])
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    for t in TARGETS:
        k = _strength(sites, t, f"{t}_host")
        sites = sites.withColumn(f"{t}_path", (F.col(t) + k * F.col(f"{t}_host")) / (F.col("n") + k))
    return sites.drop(*TARGETS)


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column, model: Model | None = None, row: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with its probabilities and ``keep``.

    Gives doc_id (or the column that ``row`` names), host, path,
    toxic and low (posterior probabilities), their ``*_document`` evidence and
    ``*_path`` means, and keep: neither is more likely than not.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(model or fit(docs, labels))
    rows = docs.select(F.col(f"`{row}`").cast("long").alias(row), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    schema = rows.drop("text").schema
    for t in TARGETS:
        schema = schema.add(f"{t}_odds", "double")
    scored = stored(rows.mapInArrow(_scored(model), schema), "quality-scores")
    sites = stored(site_posteriors(scored), "quality-sites")
    sites = sites.select(F.col("host").alias("site_host"), F.col("path").alias("site_path"), "n", *[f"{t}_{x}" for t in TARGETS for x in ("global", "path")])
    sites = F.broadcast(sites) if sites.count() <= BROADCAST_SITES else sites
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")))
    posterior = [
        _p(F.col(f"{t}_odds") + _odds(F.col(f"{t}_path")) - _odds(F.col(f"{t}_global"))).alias(t) for t in TARGETS
    ]
    out = joined.select(
        schema.names[0], "host", "path", F.col("n").alias("path_docs"), *posterior,
        *[_p(F.col(f"{t}_odds")).alias(f"{t}_document") for t in TARGETS], *[f"{t}_path" for t in TARGETS],
    )
    return out.withColumn("keep", (F.col("toxic") < 0.5) & (F.col("low") < 0.5))


def kept(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, columns as they are."""
    whole = positioned(docs, "quality-docs")
    with temporary(docs.sparkSession):
        row = "doc_row"
        while row in docs.columns:
            row += "_"
        rows = whole.select(F.col("doc_row").alias(row), "doc.*")
        rejected = judged(rows, labels, host, path, fit(docs, labels), row).filter(~F.col("keep")).select(row)
        good = without(whole, rejected, "rejected")
    return unpacked(good, docs.columns)
