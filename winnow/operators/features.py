"""Feature engineering: account history, rolling counts, encodings, interactions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, RobustScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.scalar import DAY_US, clip, day_number, micros, month_start, parse_yearmonth, safe_ratio, temporal_parts
from winnow.operators.kernels import MAX_HOT_KEYS, exact_quantiles, prefix_sums, rows_per_task, uniform_key
from winnow.session import pin, stored

WINDOWS = (30, 90, 180)
MAX_LEVELS = 1000  # most levels a literal list may hold
FRAME_ROWS = 500  # most rows of an account handled by sliding frames


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def valid_windows(windows: Sequence[int]) -> list[int]:
    return [max(1, int(w)) for w in windows]


def window_label(days: int) -> str:
    return f"L{days // 30}M" if days % 30 == 0 else f"{days}D"


# ---------------------------------------------------------------- account history


def _counters(windows: Sequence[int], sources: Sequence[str]) -> list[tuple[str, int, str | None]]:
    out: list[tuple[str, int, str | None]] = []
    for w in windows:
        out.append((f"lead_cnt_{window_label(w)}", w, None))
        out += [(f"lead_cnt_{s}_{window_label(w)}", w, s) for s in sources]
    return out


def _hit(source: str, value: str | None) -> Column:
    return F.lit(1) if value is None else F.when(q(source) == value, 1).otherwise(0)


def account_history(
    df: DataFrame, account: str, time: str, row_id: str, windows: Sequence[int] = (), source: str | None = None,
    sources: Sequence[str] = (), task_rows: int | None = None, frame_rows: int = FRAME_ROWS,
) -> DataFrame:
    """Per row: earlier leads of the account, days since the last one, and counts in ``[t-W, t)``.

    Small accounts use one sort and window frames; a sliding frame costs its own length per
    row, so busy accounts read their counts off running totals instead, cut into time
    buckets so that none is ordered by one task. A row without account has no history.
    """
    windows = valid_windows(windows)
    rows = df.withColumn("_t", micros(F.col(time)))
    limit = min(frame_rows, task_rows or frame_rows) if windows else rows_per_task(df, task_rows)
    busy = (
        df.filter(F.col(account).isNotNull()).groupBy(account).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
        .select(account)
    )
    names = [r[0] for r in busy.limit(MAX_HOT_KEYS + 1).collect()]
    if not names:
        return _history_by_frames(rows, account, row_id, windows, source, sources).drop("_t")
    if len(names) <= MAX_HOT_KEYS:
        is_busy = F.coalesce(F.col(account).isin(names), F.lit(False))
        calm, crowded = rows.filter(~is_busy), rows.filter(is_busy)
    else:
        calm, crowded = rows.join(busy, account, "left_anti"), rows.join(busy, account, "left_semi").select(*rows.columns)
    return (
        _history_by_frames(calm.select(*rows.columns), account, row_id, windows, source, sources)
        .unionByName(_history_by_prefix(crowded, account, row_id, windows, source, sources, task_rows)).drop("_t")
    )


def _history_by_frames(rows, account, row_id, windows, source, sources) -> DataFrame:
    # rows without account form no group: each stands alone
    key = [account, F.when(F.col(account).isNull(), F.col(row_id))]
    ordered = Window.partitionBy(*key).orderBy("_t", row_id)
    since = F.floor((F.col("_t") - F.lag("_t").over(ordered)) / DAY_US).cast("int")
    out = rows.select(
        "*", (F.row_number().over(ordered) - 1).alias("cum_leads_account"),
        F.coalesce(since, F.lit(-1)).alias("days_since_prev_lead"),
    )
    by_time = Window.partitionBy(*key).orderBy("_t")
    return out.select("*", *[
        F.coalesce(F.sum(_hit(source, s)).over(by_time.rangeBetween(-w * DAY_US, -1)), F.lit(0)).cast("long").alias(name)
        for name, w, s in _counters(windows, sources)
    ])


def _history_by_prefix(rows, account, row_id, windows, source, sources, task_rows) -> DataFrame:
    # a key of our own, pinned: rows may lack an id or share one
    rows = pin(rows.withColumn("_rid", F.monotonically_increasing_id()))
    ranked = prefix_sums(
        rows, [account], "_t", {"_pos": F.lit(1)}, row_id, task_rows, maxima={"_last": F.col("_t")}
    )
    since = F.floor((F.col("_t") - F.col("_last")) / DAY_US).cast("int")
    out = ranked.select(
        *rows.columns, F.col("_pos").cast("int").alias("cum_leads_account"),
        F.coalesce(since, F.lit(-1)).alias("days_since_prev_lead"),
    )
    counters = _counters(windows, sources)
    if not counters:
        return out.drop("_rid")
    # leads in [t-W, t) = leads before t minus leads before t-W; both are read off a running
    # count at probe points, which sort ahead of the leads of the same instant
    spots = F.array(
        F.struct(F.lit(-1).alias("_w"), (F.col("_t") * 2 + 1).alias("_at")),
        *[F.struct(F.lit(w).alias("_w"), ((F.col("_t") - w * DAY_US) * 2).alias("_at")) for w in [0, *windows]],
    )
    keep = [account, "_rid"] + ([source] if source else [])
    events = rows.select(*keep, F.inline(spots))
    kinds = {None: "_all", **{s: f"_s{i}" for i, s in enumerate(sources)}}
    counts = prefix_sums(
        events, [account], "_at",
        {name: F.when(F.col("_w") < 0, _hit(source, s)).otherwise(0) for s, name in kinds.items()}, "_rid", task_rows,
    )
    at = lambda name, w: F.max(F.when(F.col("_w") == w, F.col(name)))
    table = counts.filter("_w >= 0").groupBy("_rid").agg(*[
        (at(kinds[s], 0) - at(kinds[s], w)).cast("long").alias(name) for name, w, s in counters
    ])
    return out.join(table, "_rid").drop("_rid")


def source_ratios(df: DataFrame, windows: Sequence[int], sources: Sequence[str]) -> DataFrame:
    """Share of each source in the account's window; an empty window gives 0."""
    out = []
    for w in valid_windows(windows):
        label = window_label(w)
        out += [
            safe_ratio(q(f"lead_cnt_{s}_{label}").cast("double"), q(f"lead_cnt_{label}").cast("double"))
            .alias(f"ratio_{s}_{label}") for s in sources
        ]
    return df.select("*", *out)


def rolling_daily_by_source(
    df: DataFrame, time: str, source: str, sources: Sequence[str], windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Leads of each source over the last W calendar days, today included, on every row.

    The window runs over one row per calendar day.
    """
    daily = df.groupBy(day_number(F.col(time)).alias("_day")).agg(*[
        F.count_if(F.col(source) == s).alias(f"_s{i}") for i, s in enumerate(sources)
    ])
    by_day = Window.partitionBy(F.lit(0)).orderBy("_day")
    rolled = daily.select("_day", *[
        F.sum(f"_s{i}").over(by_day.rangeBetween(1 - w, 0)).alias(
            f"lead_cnt_{s.replace(' ', '_').replace('-', '_')}_{window_label(w)}"
        )
        for w in valid_windows(windows) for i, s in enumerate(sources)
    ])
    return df.withColumn("_day", day_number(F.col(time))).join(rolled, "_day", "left").drop("_day")


# ---------------------------------------------------------------- keyed state


@dataclass
class KeyedState:
    """Train-frozen ``key -> value`` table; unseen keys get the default.

    It stays a DataFrame. Spark broadcasts it only when its size allows.
    """

    keys: list[str]
    table: DataFrame
    value: str
    default: object

    def transform(self, df: DataFrame) -> DataFrame:
        joined = df.join(self.table, self.keys, "left")
        return joined.withColumn(self.value, F.coalesce(F.col(self.value), F.lit(self.default)))


def fit_account_totals(train: DataFrame, account: str) -> KeyedState:
    table = train.filter(F.col(account).isNotNull()).groupBy(account).agg(F.count(F.lit(1)).alias("account_total_leads"))
    return KeyedState([account], table, "account_total_leads", 0)


def cross_column(a: str, b: str) -> Column:
    """Both texts joined by ``_``; a missing side reads ``nan``."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("nan"))
    return F.concat(part(a), F.lit("_"), part(b))


def fit_frequencies(train: DataFrame, key: str, out: str) -> KeyedState:
    """Share of train rows per value."""
    counts = train.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    table = counts.select(key, (F.col("_n") / total).alias(out))
    return KeyedState([key], table, out, 0.0)


def fit_rare_levels(train: DataFrame, column: str, min_rows: int = 50) -> DataFrame:
    return (
        train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") < min_rows).select(column, F.lit(True).alias("_rare"))
    )


def bucket_rare(df: DataFrame, column: str, rare: DataFrame, out: str, label: str = "RARE") -> DataFrame:
    return (
        df.join(rare, column, "left")
        .withColumn(out, F.when(F.col("_rare"), label).otherwise(F.col(column))).drop("_rare")
    )


def fit_target_encoding(train: DataFrame, column: str, target: str, smoothing: float = 10.0,
                        out: str | None = None) -> KeyedState:
    """Category mean shrunk to the prior with the weight of ``smoothing`` rows; unseen -> prior."""
    out = out or f"{column}_te"
    prior = train.agg(F.avg(target)).first()[0]
    stats = train.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(target).alias("_n"), F.sum(target).alias("_s")
    )
    table = stats.select(column, ((F.col("_s") + smoothing * prior) / (F.col("_n") + smoothing)).alias(out))
    return KeyedState([column], table, out, prior)


def ordered_target_encode(df: DataFrame, column: str, target: str, row_id: str, strength: float = 1.0, prior: float | None = None,
                          seed: int = 42, out: str | None = None, task_rows: int | None = None) -> DataFrame:
    """Category mean of the rows before this one in a drawn order, shrunk to the prior: no row sees its own label.

    The order is that of the ids' digests, so it is the same under any partitioning; a category with very many rows is cut
    along it. A row whose target is missing adds nothing; missing categories are one category. New rows are encoded by
    :func:`fit_target_encoding`, which sees all train rows.
    """
    out = out or f"{column}_ots"
    if prior is None:
        prior = df.agg(F.avg(target)).first()[0] or 0.0
    y = F.col(target).cast("double")
    drawn = df.withColumn("_ots_order", uniform_key(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed)))))
    sums = {"_ots_s": F.coalesce(y, F.lit(0.0)), "_ots_n": y.isNotNull().cast("long")}
    before = prefix_sums(drawn, [column], "_ots_order", sums, row_id, task_rows)
    mean = (F.col("_ots_s") + strength * prior) / (F.col("_ots_n") + strength)
    return before.withColumn(out, mean).drop("_ots_order", "_ots_s", "_ots_n")


def levels(train: DataFrame, column: str, limit: int = MAX_LEVELS) -> list[str]:
    """Sorted distinct values, checked to be few; NULL is the level ``Unknown``."""
    cell = F.coalesce(F.col(column).cast("string"), F.lit("Unknown"))
    got = [r[0] for r in train.select(cell).distinct().limit(limit + 1).collect()]
    if len(got) > limit:
        raise ValueError(f"{column} has more than {limit} levels; use the vector encoder")
    return sorted(got)


def top_sources(train: DataFrame, source: str, min_share: float = 0.01) -> list[str]:
    """Sources above the share; there are fewer than 1/min_share of them."""
    counts = train.filter(F.col(source).isNotNull()).groupBy(source).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return sorted(r[0] for r in counts.filter(F.col("_n") > min_share * total).collect())


def source_onehot(df: DataFrame, source: str, sources: Sequence[str]) -> DataFrame:
    known = F.col(source).isin(list(sources))
    return df.select(
        "*", *[F.coalesce((F.col(source) == s).cast("int"), F.lit(0)).alias(f"is_src_{s}") for s in sources],
        F.when(known, 0).otherwise(1).alias("is_src_Other"),
    )


def onehot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """0/1 columns; NULL reads ``Unknown``; a level not seen in training gives zeros."""
    cell = F.coalesce(F.col(column).cast("string"), F.lit("Unknown"))
    return df.select("*", *[(cell == v).cast("int").alias(f"{column}_{v}") for v in values])


@dataclass
class RobustScaleModel:
    center: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        return df.select("*", *[
            ((F.coalesce(F.col(c).cast("double"), F.lit(m)) - m) / (self.scale[c] or 1.0)).alias(c + suffix)
            for c, m in self.center.items()
        ])


def fit_robust_scale(train: DataFrame, columns: Sequence[str]) -> RobustScaleModel:
    """Median imputation, then (x - median) / IQR of the imputed column; exact quantiles."""
    if not train.is_cached:
        train = stored(train.select(*columns), "train")
    medians = exact_quantiles(train, columns, (0.5,), durable=False)
    filled = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0])).alias(c) for c in columns])
    lines = exact_quantiles(filled, columns, (0.25, 0.5, 0.75), durable=False)
    return RobustScaleModel({c: v[1] for c, v in lines.items()}, {c: v[2] - v[0] for c, v in lines.items()})


def vector_encoder(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> Pipeline:
    """Spark ML stages: median imputation + robust scaling, index + one-hot, one vector."""
    stages, parts = [], []
    if numeric:
        filled = [f"{c}__f" for c in numeric]
        stages += [
            Imputer(strategy="median", inputCols=list(numeric), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="_num"),
            RobustScaler(withCentering=True, withScaling=True, inputCol="_num", outputCol="_num_scaled"),
        ]
        parts.append("_num_scaled")
    if categorical:
        index, hot = [f"{c}__i" for c in categorical], [f"{c}__h" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
        parts += hot
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return Pipeline(stages=stages)


# ---------------------------------------------------------------- interactions


def _number(c: str) -> Column:
    return F.col(c).cast("double")


def ratio_pairs(columns: Sequence[str], max_pairs: int = 20) -> list[tuple[str, str]]:
    pairs = list(combinations(columns, 2))
    if len(pairs) <= max_pairs:
        return pairs
    return list(combinations(columns[: int((2 * max_pairs) ** 0.5)], 2))[:max_pairs]


def pairwise_ratios(df: DataFrame, columns: Sequence[str], max_pairs: int = 20, epsilon: float = 1e-8,
                    limit: float | None = 1e6, shift: bool = True) -> DataFrame:
    """``a_DIV_b``; a zero divisor reads epsilon, and with ``shift`` epsilon is added to every divisor."""
    out = []
    for a, b in ratio_pairs(columns, max_pairs):
        divisor = F.when(_number(b) == 0, epsilon).otherwise(_number(b)) + (epsilon if shift else 0.0)
        value = _number(a) / F.nullif(divisor, F.lit(0.0))
        value = value if limit is None else clip(value, -limit, limit)
        out.append(F.coalesce(value, F.lit(0.0)).alias(f"{a}_DIV_{b}"))
    return df.select("*", *out)


def pairwise_products(df: DataFrame, columns: Sequence[str], top_k: int = 10, limit: float | None = 1e9) -> DataFrame:
    """``a_X_b`` over the first ``top_k`` columns."""
    out = []
    for a, b in combinations(columns[:top_k], 2):
        value = _number(a) * _number(b)
        value = value if limit is None else clip(value, -limit, limit)
        out.append(F.coalesce(value, F.lit(0.0)).alias(f"{a}_X_{b}"))
    return df.select("*", *out)


# ---------------------------------------------------------------- the engineer


@dataclass
class FeatureModel:
    spec: "FeatureEngineer"
    sources: list[str]
    totals: KeyedState
    cross: KeyedState | None
    rare: DataFrame | None

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.spec
        when = F.col(s.time)
        ym = parse_yearmonth(F.col(s.yearmonth)) if s.yearmonth in df.columns else month_start(when)
        out = df.select("*", ym.alias("_ym_date"), *temporal_parts(when))
        if df.isStreaming:
            from winnow.streaming.history import stream_history

            out = stream_history(out, s.account, s.time, s.row_id, s.windows, s.source, self.sources, s.late)
        else:
            out = account_history(out, s.account, s.time, s.row_id, s.windows, s.source, self.sources, s.task_rows)
        out = source_ratios(source_onehot(out, s.source, self.sources), s.windows, self.sources)
        if self.cross:
            out = self.cross.transform(out.withColumn("src_chan_cross", cross_column(s.source, s.channel)))
        if self.rare is not None:
            out = bucket_rare(out, s.record_type, self.rare, "RecordType_bucketed")
        out = self.totals.transform(out)
        if not s.keep_original:
            out = out.drop(s.time, s.source, s.yearmonth, s.channel or "", s.record_type or "")
        return out.drop(*s.drop_ids)

    def save(self, path: str) -> None:
        """Keyed tables as parquet, the rest as one JSON row."""
        spark = self.totals.table.sparkSession
        tables = {"totals": self.totals.table} | ({"cross": self.cross.table} if self.cross else {}) | ({"rare": self.rare} if self.rare is not None else {})
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        held = {n: [k.keys, k.value, k.default] for n, k in (("totals", self.totals), ("cross", self.cross)) if k}
        state = {"spec": asdict(self.spec), "sources": self.sources, "keyed": held, "rare": self.rare is not None}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark, path: str) -> "FeatureModel":
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        keyed = {n: KeyedState(k[0], spark.read.parquet(f"{path}/{n}"), k[1], k[2]) for n, k in state["keyed"].items()}
        rare = spark.read.parquet(f"{path}/rare") if state["rare"] else None
        return cls(FeatureEngineer(**state["spec"]), state["sources"], keyed["totals"], keyed.get("cross"), rare)


@dataclass
class FeatureEngineer:
    """Everything learned is learned in ``fit``, on the training rows only."""

    time: str
    account: str
    source: str
    row_id: str
    channel: str | None = None
    record_type: str | None = None
    yearmonth: str = "YearMonth"
    windows: Sequence[int] = WINDOWS
    min_share: float = 0.01
    rare_rows: int = 50
    keep_original: bool = True
    drop_ids: Sequence[str] = field(default=())
    task_rows: int | None = None
    late: str = "0 seconds"  # how far a stream's rows may come out of order

    def fit(self, train: DataFrame) -> FeatureModel:
        cross = rare = None
        if self.channel:
            crossed = train.select(cross_column(self.source, self.channel).alias("src_chan_cross"))
            cross = fit_frequencies(crossed, "src_chan_cross", "src_chan_freq_enc")
        if self.record_type:
            rare = fit_rare_levels(train, self.record_type, self.rare_rows)
        return FeatureModel(
            self, top_sources(train, self.source, self.min_share), fit_account_totals(train, self.account), cross, rare
        )
