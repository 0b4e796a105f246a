"""Gradient boosting by histograms, for one model or one a key (M4, M13), in one set of jobs.

Every key's rows are quantised and packed into blocks of at most MAX_ROWS rows:
one byte a feature, the label, a hash that draws samples.  A key with one block
is boosted where the block lies, so thousands of keys are fitted by one job,
each in the task that holds its rows, and nothing but the blocks is shuffled.
A key with more rows keeps as many blocks as it needs and no task holds it: for
every level of a tree the blocks' counts by (model, node, feature, bin) are
summed by a grouped aggregation, the best splits are picked per model, and only
those, at most 2^depth a tree, pass the driver.  Counts are integers, so both
ways give the same model, number for number (histograms.py).

Bin edges and the first prediction are exact order statistics.  A finished
model is flat node arrays: it scores all trees in one pass over Arrow batches
and is written to and read from shared storage, one row for each tree.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.ml import histograms as H
from stationcast.ml.histograms import Block, Settings, State, Tree
from stationcast.operators.common import cut_lineage, join_on, stage_path
from stationcast.operators.positions import global_positions

#: Rows of a block.
MAX_ROWS = 200_000
#: Models that a task fits one after the other, at most; bounds the blocks in an Arrow batch.
MODELS_A_TASK = 4
_PACKED = "x binary, y binary, h binary, test binary"


def pinball(y: Column, q: Column, alpha: float) -> Column:
    """Pinball (quantile) loss of prediction ``q`` for target ``y``."""
    r = y - q
    return F.when(r >= 0, F.lit(alpha) * r).otherwise(F.lit(alpha - 1.0) * r)


@dataclass
class NodeArrays:
    """A tree over values: feature (-1: leaf), threshold (not above goes left), left child, value, gain, training rows."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @staticmethod
    def of(tree: Tree, edges: Sequence[np.ndarray]) -> "NodeArrays":
        threshold = np.array([np.nextafter(edges[f][b], -np.inf) if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.bin)])
        return NodeArrays(tree.feature.astype(np.int32), threshold, tree.left.astype(np.int32), tree.value, tree.gain, tree.cover)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row; each step moves all open rows a level down."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(rows):
            here = at[rows]
            at[rows] = self.left[here] + ~(x[rows, self.feature[here]] <= self.threshold[here])
            rows = rows[self.feature[at[rows]] >= 0]
        return at


@dataclass
class QuantileGBTModel:
    features: list[str]
    alpha: float
    base: float
    learning_rate: float  # of one tree
    trees: list[NodeArrays] = field(default_factory=list)
    history: list[tuple[int, float | None]] = field(default_factory=list)

    @staticmethod
    def of(state: State, edges: Sequence[np.ndarray], features: Sequence[str], s: Settings) -> "QuantileGBTModel":
        kept = state.trees[: state.best() * s.parallel_trees]
        return QuantileGBTModel(list(features), s.alpha, state.base, s.learning_rate / s.parallel_trees, [NodeArrays.of(t, edges) for t in kept],
                                [(r, None if np.isnan(e) else e) for r, e in enumerate(state.errors)])

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for t in self.trees:
            total += self.learning_rate * t.value[t.leaves(x)]
        return total

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Score rows in one pass; a row with a null feature gets null."""
        shared = df.sparkSession.sparkContext.broadcast(self)  # trees x nodes, set by the settings

        @F.pandas_udf("double")
        def score(*columns):
            import pandas as pd
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
            return pd.Series(np.where(np.isnan(x).any(axis=1), np.nan, shared.value.predict(x))).astype("Float64")
        out = score(*[F.col(f"`{c}`").cast("double") for c in self.features])
        complete = F.lit(True)
        for c in self.features:
            complete = complete & F.col(f"`{c}`").isNotNull()
        return df.withColumn(output, F.when(complete, out))

    def save(self, spark: SparkSession, path: str) -> str:
        """Write the model as Parquet under ``path`` (shared storage): row 0 holds the
        settings, every other row a tree."""
        head = json.dumps({"features": self.features, "alpha": self.alpha, "base": self.base, "learning_rate": self.learning_rate, "history": self.history})
        rows = [(0, head, [], [], [], [], [], [])] + [(i + 1, None, *[getattr(t, c).tolist() for c in _ARRAYS]) for i, t in enumerate(self.trees)]
        schema = "tree int, head string, feature array<int>, threshold array<double>, left array<int>, value array<double>, gain array<double>, cover array<double>"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "QuantileGBTModel":
        rows = spark.read.parquet(path).orderBy("tree").collect()  # one row per tree
        head = json.loads(rows[0]["head"])
        kinds = dict(zip(_ARRAYS, (np.int32, float, np.int32, float, float, float)))
        return QuantileGBTModel(head["features"], head["alpha"], head["base"], head["learning_rate"],
                                [NodeArrays(*[np.array(r[c], kinds[c]) for c in _ARRAYS]) for r in rows[1:]], [tuple(h) for h in head["history"]])

    def gain_importance(self) -> dict[str, float]:
        """Mean, over the trees that split, of each tree's shares of gain per feature."""
        total, n = np.zeros(len(self.features)), 0
        for t in self.trees:
            own = np.bincount(t.feature[t.feature >= 0], weights=t.gain[t.feature >= 0], minlength=len(self.features))
            if own.sum() > 0:
                total, n = total + own / own.sum(), n + 1
        return dict(zip(self.features, (total / max(n, 1)).tolist()))


_ARRAYS = ("feature", "threshold", "left", "value", "gain", "cover")


# -- rows into blocks ------------------------------------------------------------------------------

def edge_bytes(edges: Sequence[np.ndarray]) -> bytes:
    return json.dumps([e.tolist() for e in edges]).encode()


def edge_arrays(body: bytes) -> list[np.ndarray]:
    return [np.array(e, float) for e in json.loads(bytes(body))]


@dataclass
class Blocks:
    """Packed rows: ``single`` (keys, edges, x, y, h, test), one row a key; ``split`` the
    same with several rows a key, and (base, step); None without such keys."""
    keys: list[str]
    features: list[str]
    single: DataFrame
    split: DataFrame | None


def _stage(df: DataFrame, name: str) -> DataFrame:
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pack(width: int, edges_in: bool, keys: int) -> Callable[[pa.Table], pa.Table]:
    """Rows (keys, f0.., label, h, test[, edges]) of a group as one packed row."""
    def pack(rows: pa.Table) -> pa.Table:
        cols = [rows.column(i) for i in range(rows.num_columns)]
        values = [cols[keys + j].to_numpy() for j in range(width)]
        y, h, test = cols[keys + width].to_numpy(), cols[keys + width + 1].to_numpy(), cols[keys + width + 2].to_numpy(zero_copy_only=False)
        edges = edge_arrays(cols[-1][0].as_py()) if edges_in else [np.unique(np.sort(v[~test])[H.edges_at(int((~test).sum()))]) for v in values]
        x = np.column_stack([H.to_bins(v, e) for v, e in zip(values, edges)])
        out = [edge_bytes(edges), x.tobytes(), y.astype(float).tobytes(), h.astype(np.int64).tobytes(), test.astype(bool).tobytes()]
        return pa.table([cols[i].slice(0, 1).combine_chunks() for i in range(keys)] + [pa.array([v], pa.binary()) for v in out],
                        names=[*rows.column_names[:keys], "edges", "x", "y", "h", "test"])
    return pack


def pack(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, test: str | None = None, max_rows: int = MAX_ROWS) -> Blocks:
    """Complete rows of ``df`` in blocks.  Rows with a null (or NaN) feature or label are
    left out, as fits need complete cases; null keys are a key like others; ``test``
    marks held-out rows (null: not held out).  Rows equal in features and label share
    their draw of samples."""
    names, types = [f"__f{j}" for j in range(len(features))], dict(df.dtypes)
    held = F.coalesce(F.col(f"`{test}`").cast("boolean"), F.lit(False)) if test else F.lit(False)
    d = df.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(f"`{f}`").cast("double").alias(n) for f, n in zip(features, names)],
                  F.col(f"`{label}`").cast("double").alias("__y"), held.alias("__test")).na.drop("any", subset=[*names, "__y"])
    if not keys:
        d = d.withColumn("__k0", F.lit(0))
    own = [f"__k{i}" for i in range(max(len(keys), 1))]
    d = cut_lineage(d.select(*own, *names, "__y", F.xxhash64(*names, "__y").alias("__h"), "__test"))
    sizes = d.groupBy(*own).agg(F.count("*").alias("__n"))
    large = cut_lineage(sizes.where(F.col("__n") > max_rows))
    key_schema = ", ".join(f"{k} {types[c]}" for k, c in zip(own, keys)) or "__k0 int"
    schema = f"{key_schema}, edges binary, {_PACKED}"
    rest, split = d, None
    if not large.isEmpty():
        rest, big = join_on(d, large.select(*own), own, "left_anti"), join_on(d, large, own)
        # exact ranks of every feature's training values, at the ranks that begin a bin
        long = big.where(~F.col("__test")).select(F.struct(*own).alias("__key"), F.posexplode(F.array(*names)).alias("__j", "__v"))
        ranked = global_positions(long.withColumn("__key", F.to_json("__key", {"ignoreNullFields": "false"})), ["__key", "__j"], "__v", ties=False)
        i = F.floor((F.col("pos") * H.BINS + F.col("n") - 1) / F.col("n"))
        begins = (F.col("pos") > 0) & (i < H.BINS) & (F.floor(i * F.col("n") / H.BINS) == F.col("pos"))
        per = ranked.where(begins).groupBy("__key", "__j").agg(F.sort_array(F.collect_set("__v")).alias("e"))  # fewer than BINS each
        every = big.select(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("__key")).distinct()
        grid = every.crossJoin(big.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("__j")))  # keys x features, empty ones too
        edges = (grid.join(per, ["__key", "__j"], "left").groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("__j", F.coalesce("e", F.array().cast("array<double>")).alias("e")))).alias("s"))
                 .select("__key", F.to_json(F.transform("s", lambda v: v["e"])).cast("binary").alias("edges")))
        train = big.where(~F.col("__test")).withColumn("__key", F.to_json(F.struct(*own), {"ignoreNullFields": "false"}))
        spans = train.groupBy("__key").agg(F.max("__y").alias("hi"), F.min("__y").alias("lo"))
        keyed = big.withColumn("__key", F.to_json(F.struct(*own), {"ignoreNullFields": "false"}))
        parts = keyed.select("*", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("__n") / max_rows)).alias("__part"))
        rows = cut_lineage(parts).join(edges, "__key")
        tagged = f"__key string, __part long, {schema}"
        packed = rows.select("__key", "__part", *own, *names, "__y", "__h", "__test", "edges").groupBy("__key", "__part").applyInArrow(_pack(len(names), True, 2 + len(own)), tagged)
        split = _stage(packed.join(spans, "__key", "left"), "boost-split")
    single = rest.select(*own, *names, "__y", "__h", "__test").groupBy(*own).applyInArrow(_pack(len(names), False, len(own)), schema)
    return Blocks(own, list(features), _stage(single, "boost-blocks"), split)


# -- keys of one block -----------------------------------------------------------------------------

def _spread(models: DataFrame) -> DataFrame:
    return models.repartition(max(1, -(-models.count() // MODELS_A_TASK)) if models.count() > 64 else max(1, models.count()))


def advance_single(blocks: Blocks, running: DataFrame, settings: dict[int, Settings], upto: int | None = None) -> DataFrame:
    """(keys, trial, body, n_train, n_test, rounds, error, pinball, done): the models of
    ``running`` (keys, trial, body or null) boosted on to ``upto`` rounds."""
    keys, width = blocks.keys, len(blocks.features)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.single.schema.fields if f.name in keys)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                s, b = settings[r["trial"]], Block.of(width, r["x"], r["y"], r["h"], r["test"])
                state = H.advance(b, s, State.from_bytes(r["body"]) if r["body"] else None, upto)
                f = np.full(len(b.y), state.base)
                for t in state.trees[: state.best() * s.parallel_trees]:
                    f += s.learning_rate / s.parallel_trees * t.value[t.leaves(b.x)]
                miss = (b.y - f)[b.test]
                row = {**{k: r[k] for k in keys}, "trial": r["trial"], "body": state.to_bytes(), "n_train": int((~b.test).sum()), "n_test": int(b.test.sum()), "rounds": state.best(),
                       "error": min(state.errors) if state.errors and len(miss) else None, "done": state.done,
                       "pinball": float(np.mean(np.maximum(s.alpha * miss, (s.alpha - 1) * miss))) if len(miss) else None,
                       "mae": float(np.mean(np.abs(miss))) if len(miss) else None}
                yield pa.RecordBatch.from_pylist([row], schema=out_schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    text = f"{schema}, trial int, body binary, n_train long, n_test long, rounds int, error double, done boolean, pinball double, mae double"
    out_schema = to_arrow_schema(blocks.single.sparkSession.createDataFrame([], text).schema)
    models = join_on(blocks.single.select(*keys, "x", "y", "h", "test"), running, keys).select(*keys, "trial", "body", "x", "y", "h", "test")
    return _stage(_spread(models).mapInArrow(fit, text), "boost-models")


# -- keys of many blocks ---------------------------------------------------------------------------

class _Split:
    """Boosts the models of keys that span several blocks, all together."""

    def __init__(self, blocks: Blocks, s: Settings, start: dict[str, State], upto: int | None):
        self.s, self.width, self.spark = s, len(blocks.features), blocks.split.sparkSession
        spans = blocks.split.groupBy("__key").agg(F.first("hi").alias("hi"), F.first("lo").alias("lo")).collect()  # one row for each large key
        self.step = {r["__key"]: max((r["hi"] - r["lo"]) if r["hi"] is not None else 0.0, 1e-12) / H.STEPS if r["hi"] is not None else 1.0 for r in spans}
        self.rows = {r["__key"]: (r["train"], r["test"]) for r in self._mapped(blocks.split, self._sizes, "__key string, train long, test long").groupBy("__key").agg(
            F.sum("train").alias("train"), F.sum("test").alias("test")).collect()}
        self.state = {k: start.get(k) or State(base) for k, base in self._bases(blocks.split).items()}
        self.data = self._advanced(blocks.split, {k: (st.base, st.trees) for k, st in self.state.items()})
        limit = min(s.n_estimators, s.n_estimators if upto is None else upto)
        while open_ := [k for k, st in self.state.items() if not st.done and len(st.errors) < limit and self.rows[k][0]]:
            self._round(open_)
        for k, st in self.state.items():
            st.done = st.done or not self.rows[k][0]

    # what a task does with a block; ``r`` is the packed row
    def _mapped(self, data: DataFrame, fn, schema: str) -> DataFrame:
        names = [x.split()[0] for x in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    cols = fn(r)
                    if cols is not None and len(cols[0]):
                        yield pa.RecordBatch.from_arrays([pa.array([r["__key"]] * len(cols[0])), *map(pa.array, cols)], names)
        return data.mapInArrow(run, schema)

    @staticmethod
    def _sizes(r: dict):
        test = np.frombuffer(r["test"], bool)
        return np.array([(~test).sum()]), np.array([test.sum()])

    def _bases(self, data: DataFrame) -> dict[str, float]:
        step, s = self.step, self.s
        if s.squared:
            def total(r):
                y, test = np.frombuffer(r["y"], float), np.frombuffer(r["test"], bool)
                return [np.array([str(sum(np.rint(y[~test] / step[r["__key"]]).astype(np.int64).tolist()))])]
            sums = self._mapped(data, total, "__key string, t string").groupBy("__key").agg(F.sum(F.col("t").cast("decimal(38,0)")).alias("t")).collect()
            return {r["__key"]: float(int(r["t"])) / self.rows[r["__key"]][0] * step[r["__key"]] if self.rows[r["__key"]][0] else 0.0 for r in sums}

        def labels(r):
            y, test = np.frombuffer(r["y"], float), np.frombuffer(r["test"], bool)
            return [y[~test]]
        ranked = global_positions(self._mapped(data, labels, "__key string, y double"), ["__key"], "y", ties=False)
        at = F.greatest(F.lit(0), F.ceil(F.lit(s.alpha) * F.col("n")) - 1)
        return {k: 0.0 for k in self.step} | {r["__key"]: r["y"] for r in ranked.where(F.col("pos") == at).select("__key", "y").collect()}

    def _advanced(self, data: DataFrame, add: dict[str, tuple[float, list[Tree]]]) -> DataFrame:
        """The blocks with their running prediction ``f`` moved on by new trees, written."""
        shared, s, width, first = self.spark.sparkContext.broadcast(add), self.s, self.width, "f" not in data.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    b = Block.of(width, r["x"], r["y"], r["h"], r["test"])
                    base, trees = shared.value.get(r["__key"], (0.0, []))
                    f = np.full(len(b.y), base) if first else np.frombuffer(r["f"], float).copy()
                    for t in trees:
                        f += s.learning_rate / s.parallel_trees * t.value[t.leaves(b.x)]
                    out.append((r["__key"], r["x"], r["y"], r["h"], r["test"], f.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 0 else pa.binary()) for k, c in enumerate(zip(*out))], ["__key", "x", "y", "h", "test", "f"])
        return _stage(data.mapInArrow(run, f"__key string, {_PACKED}, f binary"), "boost-running")

    def _picked(self, fn, schema: str, order: list[str], sums: list[str], pick, out: str) -> dict[str, list]:
        """{key: rows of ``pick``} over the summed counts of each key, in a task of its own."""
        names = [x.split()[0] for x in out.split(", ")]
        counts = self._mapped(self.data, fn, schema).groupBy("__key", *order).agg(*[F.sum(c).alias(c) for c in sums])

        def run(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([(c, "ascending") for c in order])
            key = rows.column("__key")[0].as_py()
            found = pick(key, *[rows.column(c).to_numpy() for c in (*order, *sums)])
            return pa.table([pa.array([key] * len(found[0]), pa.string()), *map(pa.array, found)], names=names)
        by: dict[str, list] = {}
        for r in counts.groupBy("__key").applyInArrow(run, out).collect():  # splits, or leaves, of one tree a key
            by.setdefault(r["__key"], []).append(r)
        return by

    def _round(self, open_: list[str]) -> None:
        s, width, sc = self.s, self.width, self.spark.sparkContext
        new: dict[str, list[Tree]] = {k: [] for k in open_}
        for number in range(s.parallel_trees):
            at = {k: len(self.state[k].errors) for k in open_}
            trees, newest, step = {k: Tree.root() for k in open_}, dict.fromkeys(open_, 0), self.step  # nodes from ``newest`` on are open

            def drawn(r):
                b = Block.of(width, r["x"], r["y"], r["h"], r["test"])
                return b, np.frombuffer(r["f"], float), H.sampled(b, s, at[r["__key"]], number)
            for _ in range(s.max_depth):
                shared = sc.broadcast({k: (trees[k], first) for k, first in newest.items()})

                def counts(r, shared=shared):
                    if r["__key"] not in shared.value:
                        return None
                    (b, f, mask), (tree, first) = drawn(r), shared.value[r["__key"]]
                    leaf = tree.leaves(b.x)
                    return H.level_counts(b, leaf, np.flatnonzero(mask & (leaf >= first)), H.signal(b.y, f, s, step[r["__key"]]), H.features_of(width, s, at[r["__key"]], number))

                def split(key, code, n, t):
                    return H.best_splits(code, n, t, H.features_of(width, s, at[key], number), s, step[key])
                found = self._picked(counts, "__key string, code long, n long, t long", ["code"], ["n", "t"], split, "__key string, node long, feature long, bin long, gain double")
                newest = {}
                for k, best in found.items():
                    best.sort(key=lambda r: r["node"])
                    newest[k] = int(trees[k].split(*[np.array([r[c] for r in best]) for c in ("node", "feature", "bin", "gain")])[0])
                if not newest:
                    break
            self._fill(trees, drawn)
            for k, t in trees.items():
                new[k].append(t)
        self.data = self._advanced(self.data, {k: (0.0, t) for k, t in new.items()})
        step, s = self.step, self.s

        def errors(r):
            y, f, test = np.frombuffer(r["y"], float), np.frombuffer(r["f"], float), np.frombuffer(r["test"], bool)
            return [np.array([str(H.error_steps(y[test], f[test], s, step[r["__key"]]))])]
        sums = self._mapped(self.data, errors, "__key string, t string").groupBy("__key").agg(F.sum(F.col("t").cast("decimal(38,0)")).alias("t")).collect()
        steps = {r["__key"]: int(r["t"]) for r in sums}
        for k in open_:
            st = self.state[k]
            st.trees += new[k]
            st.errors.append(H.error_of(steps[k], self.rows[k][1], s, step[k]))
            st.done = H.stopped(st.errors, s)

    def _fill(self, trees: dict[str, Tree], drawn) -> None:
        """Leaf values from the residuals of the sampled rows."""
        s, step, shared = self.s, self.step, self.spark.sparkContext.broadcast(trees)
        if s.squared:
            def sums(r):
                if r["__key"] not in shared.value:
                    return None
                b, f, mask = drawn(r)
                tree = shared.value[r["__key"]]
                leaf, t = tree.leaves(b.x)[mask], H.signal(b.y, f, s, step[r["__key"]])[mask]
                total = np.zeros(len(tree.value), np.int64)
                np.add.at(total, leaf, t)
                n = np.bincount(leaf, minlength=len(total))
                return np.arange(len(total)), n, total
            by = self._picked(sums, "__key string, leaf long, n long, t long", ["leaf"], ["n", "t"], lambda key, *cols: cols, "__key string, leaf long, n long, t long")
            for k, tree in trees.items():
                n, t = np.zeros(len(tree.value), np.int64), np.zeros(len(tree.value), np.int64)
                for r in by.get(k, []):
                    n[r["leaf"]], t[r["leaf"]] = r["n"], r["t"]
                tree.value = t * step[k] / (n + s.reg_lambda)
                tree.covered(n)
            return

        def ends(r):
            if r["__key"] not in shared.value:
                return None
            b, f, mask = drawn(r)
            residual = (b.y - f)[mask]
            return (np.array([residual.min()]), np.array([residual.max()])) if len(residual) else None
        spans = {r["__key"]: (r["lo"], r["hi"]) for r in self._mapped(self.data, ends, "__key string, lo double, hi double").groupBy("__key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}

        def bins(r, inside=None):
            key = r["__key"]
            if key not in shared.value or key not in spans:
                return None
            b, f, mask = drawn(r)
            tree, (low, high) = shared.value[key], spans[key]
            leaf, residual = tree.leaves(b.x)[mask], (b.y - f)[mask]
            lows, widths = np.full(len(tree.value), low), np.full(len(tree.value), (high - low) / H.RANGES)
            leaf, bin_, n = H._inside(leaf, residual, lows, widths, inside.value[key]) if inside else H.count_pairs(leaf, H.residual_bins(residual, lows[leaf], widths[leaf]))
            return leaf, bin_, n

        def place(ranks=None):
            def pick(key, leaf, bin_, n):
                totals = np.bincount(leaf, weights=n).astype(int)
                rank = ranks.value[key] if ranks else {int(x): H.quantile_rank(int(totals[x]), s.alpha) for x in np.unique(leaf)}
                got = H.quantile_bins(leaf, bin_, n, rank)
                return [np.array(list(got)), np.array([v[0] for v in got.values()]), np.array([rank[x] - v[1] for x, v in got.items()]), np.array([int(totals[x]) for x in got])]
            return pick
        schema, out = "__key string, leaf long, bin long, n long", "__key string, leaf long, bin long, rest long, rows long"
        first = self._picked(bins, schema, ["leaf", "bin"], ["n"], place(), out)
        picked = {k: np.full(len(t.value), -1) for k, t in trees.items()}
        for k, rows in first.items():
            cover = np.zeros(len(trees[k].value))
            for r in rows:
                picked[k][r["leaf"]], cover[r["leaf"]] = r["bin"], r["rows"]
            trees[k].covered(cover)
        sc = self.spark.sparkContext
        inside, ranks = sc.broadcast(picked), sc.broadcast({k: {r["leaf"]: r["rest"] for r in rows} for k, rows in first.items()})
        second = self._picked(lambda r: bins(r, inside), schema, ["leaf", "bin"], ["n"], place(ranks), out)
        for k, rows in second.items():
            low, high = spans[k]
            width = (high - low) / H.RANGES
            for r in rows:
                trees[k].value[r["leaf"]] = low + (picked[k][r["leaf"]] + (r["bin"] + 0.5) / H.RANGES) * width


    def results(self, trial: int, blocks: Blocks) -> DataFrame:
        """The rows that ``advance_single`` gives, for the models of this fit."""
        s, width = self.s, self.width
        shared = self.spark.sparkContext.broadcast({k: (st.base, st.trees[: st.best() * s.parallel_trees]) for k, st in self.state.items()})

        def misses(r):
            b, (base, trees) = Block.of(width, r["x"], r["y"], r["h"], r["test"]), shared.value[r["__key"]]
            f = np.full(len(b.y), base)
            for t in trees:
                f += s.learning_rate / s.parallel_trees * t.value[t.leaves(b.x)]
            miss = (b.y - f)[b.test]
            return np.array([np.maximum(s.alpha * miss, (s.alpha - 1) * miss).sum()]), np.array([np.abs(miss).sum()])
        sums = {r["__key"]: r for r in self._mapped(self.data, misses, "__key string, p double, a double").groupBy("__key").agg(F.sum("p").alias("p"), F.sum("a").alias("a")).collect()}
        rows = []
        for k, st in self.state.items():
            n, held = self.rows[k]
            rows.append((k, trial, st.to_bytes(), n, held, st.best(), min(st.errors) if st.errors and held else None, st.done,
                         sums[k]["p"] / held if held else None, sums[k]["a"] / held if held else None))
        table = self.spark.createDataFrame(rows, "__key string, trial int, body binary, n_train long, n_test long, rounds int, error double, done boolean, pinball double, mae double")
        names = blocks.split.select("__key", *blocks.keys).distinct()
        return names.join(table, "__key").drop("__key")


def advance_models(blocks: Blocks, running: DataFrame, settings: dict[int, Settings], upto: int | None = None) -> DataFrame:
    """The models of ``running`` (keys, trial, body) boosted on, those of large keys too."""
    out = advance_single(blocks, running, settings, upto)
    if blocks.split is None:
        return out
    for trial, s in settings.items():
        mine = running.where(F.col("trial") == trial)
        known = blocks.split.select("__key", *blocks.keys).distinct()
        rows = join_on(mine, known, blocks.keys).select("__key", "body").collect()  # one row for each large key
        if rows:
            start = {r["__key"]: State.from_bytes(r["body"]) for r in rows if r["body"]}
            some = blocks.split.where(F.col("__key").isin([r["__key"] for r in rows]))
            out = out.unionByName(_Split(replace(blocks, split=some), s, start, upto).results(trial, blocks))
    return out


def new_models(blocks: Blocks, trials: Sequence[int]) -> DataFrame:
    """(keys, trial, body): a model without trees for every key and trial."""
    spark = blocks.single.sparkSession
    keys = blocks.single.select(*blocks.keys)
    if blocks.split is not None:
        keys = keys.unionByName(blocks.split.select(*blocks.keys).distinct())
    table = spark.createDataFrame([(int(t),) for t in trials], "trial int")
    return keys.crossJoin(F.broadcast(table)).withColumn("body", F.lit(None).cast("binary"))  # keys x trials models are what was asked for


def fit_models(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, test: str | None, settings: Settings, max_rows: int = MAX_ROWS) -> DataFrame:
    """(keys, n_train, n_test, rounds, error, pinball, mae, edges, body): one model a key.

    Incomplete rows are left out, null keys are a key like others, a key without
    training rows has a model without trees; an empty table gives an empty result."""
    blocks = pack(df, keys, features, label, test, max_rows)
    models = advance_models(blocks, new_models(blocks, [0]), {0: settings})
    edges = blocks.single.select(*blocks.keys, "edges")
    if blocks.split is not None:
        edges = edges.unionByName(blocks.split.groupBy(*blocks.keys).agg(F.first("edges").alias("edges")))
    return join_on(models, edges, blocks.keys).select(*[F.col(k).alias(c) for k, c in zip(blocks.keys, keys)], "n_train", "n_test", "rounds", "error", "pinball", "mae", "edges", "body")


class QuantileGBT:
    """Boosted trees minimising pinball loss at quantile ``alpha``."""

    def __init__(self, features: Sequence[str], label: str, alpha: float = 0.95, max_depth: int = 4, learning_rate: float = 0.3,
                 n_estimators: int = 50, subsample: float = 1.0, colsample: float = 1.0, early_stopping: int = 50, seed: int = 0,
                 min_instances: int = 1, max_rows: int = MAX_ROWS):
        self.features, self.label, self.max_rows = list(features), label, max_rows
        self.settings = Settings(alpha=alpha, max_depth=max_depth, learning_rate=learning_rate, n_estimators=n_estimators, subsample=subsample,
                                 colsample=colsample, early_stopping=early_stopping, seed=seed, min_instances=min_instances)

    def fit(self, train: DataFrame, valid: DataFrame | None = None) -> QuantileGBTModel:
        """Boosts on ``train``; with ``valid`` until its mean absolute error no longer falls."""
        cols = [*[F.col(f"`{c}`") for c in self.features], F.col(f"`{self.label}`")]
        rows = train.select(*cols, F.lit(False).alias("__held"))
        if valid is not None:
            rows = rows.unionByName(valid.select(*cols, F.lit(True).alias("__held")))
        r = fit_models(rows, [], self.features, self.label, "__held", self.settings, self.max_rows).first()  # one model
        if r is None:
            return QuantileGBTModel(self.features, self.settings.alpha, 0.0, self.settings.learning_rate)
        return QuantileGBTModel.of(State.from_bytes(r["body"]), edge_arrays(r["edges"]), self.features, self.settings)
