"""Declarative feature views and their retrieval joins.

A ``FeatureView`` names a keyed, time-stamped source frame with a TTL. Retrieval:

* ``point_in_time_views`` (J1, J4): for each entity row the newest row of every view of one key with
  ``t - ttl <= event_ts <= t`` (ties by ``created``). One union of all views' rows and the entity rows, one window
  partitioned by key *and* time bucket with a ``last`` per view, plus one carry row per entity bucket from a prefix
  scan in levels; hot keys get finer buckets. Feature rows are never copied, no pairs are ever formed, and no window
  partition holds a whole key. ``point_in_time_join`` is the case of one view.
* ``latest_per_key`` (W2) with partial aggregation for batch scoring,
  materialisation and pushes.
* ``online_lookup`` (J3): a left join of request rows with the online table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIDE_FEATURE, _SIDE_ENTITY = 0, 1


@dataclass(frozen=True)
class Entity:
    """A named entity with its join keys."""
    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class FileSource:
    """A Parquet batch source with its event-time and created-time columns."""
    path: str
    timestamp_field: str = "event_timestamp"
    created_field: str | None = "created"
    schema: T.StructType | None = None

    def read(self, spark) -> DataFrame:
        reader = spark.read if self.schema is None else spark.read.schema(self.schema)
        return reader.parquet(self.path)


@dataclass(frozen=True)
class RequestSource:
    """Values known only at request time, as typed columns of the caller's frame."""
    name: str
    schema: T.StructType

    def check(self, df: DataFrame) -> DataFrame:
        """Cast request columns to the declared types; raise when one is missing."""
        missing = [f.name for f in self.schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"request source {self.name} misses columns {missing}")
        types = {f.name: f.dataType for f in self.schema.fields}
        return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class FeatureView:
    """Keyed features from a time-stamped source, valid for ``ttl`` after their event time."""
    name: str
    entity: Entity
    features: tuple[str, ...]
    ttl: timedelta | None = timedelta(days=1)
    timestamp_field: str = "event_timestamp"
    created_field: str | None = "created"
    tags: dict = field(default_factory=dict, hash=False, compare=False)
    descriptions: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def keys(self) -> tuple[str, ...]:
        return self.entity.keys

    def schema(self, types: dict[str, T.DataType] | None = None) -> T.StructType:
        """The view's fields as a StructType; descriptions and tags ride in field metadata."""
        types = types or {}
        return T.StructType([T.StructField(f, types.get(f, T.DoubleType()), True,
                                           {"description": self.descriptions.get(f, ""), "view": self.name,
                                            "tags": dict(self.tags)}) for f in self.features])

    def select(self, *names: str) -> "FeatureRef":
        """Sub-select fields, e.g. ``view.select("purchase_share")``."""
        unknown = [n for n in names if n not in self.features]
        if unknown:
            raise KeyError(f"{self.name} has no field(s) {unknown}")
        return FeatureRef(self, tuple(names))


@dataclass(frozen=True)
class FeatureRef:
    view: FeatureView
    fields: tuple[str, ...]


@dataclass(frozen=True)
class OnDemandView:
    """Features computed from view fields and request columns.

    ``fn(columns) -> dict[name, Column]`` receives a name->Column accessor and
    returns Column expressions, so the transform stays inside codegen and the same
    definition runs in batch and streaming plans.
    """
    name: str
    sources: tuple  # FeatureView(s) and request column names
    outputs: tuple[str, ...]
    fn: object

    def columns(self) -> dict[str, Column]:
        exprs = self.fn(F.col)
        return {n: exprs[n].cast("double") for n in self.outputs}

    def select(self, *names: str) -> "OnDemandRef":
        return OnDemandRef(self, tuple(names))


@dataclass(frozen=True)
class OnDemandRef:
    view: OnDemandView
    fields: tuple[str, ...]


@dataclass(frozen=True)
class FeatureService:
    """A named, ordered list of view sub-selections and on-demand views; ``log_path`` keeps what it serves."""
    name: str
    items: tuple
    log_path: str | None = None


def parse_refs(refs: list[str], views: dict) -> tuple:
    """``["view:field", ...]`` -> grouped refs, in first-seen order."""
    grouped: dict[str, list[str]] = {}
    for r in refs:
        vname, fname = r.split(":", 1)
        grouped.setdefault(vname, []).append(fname)
    return tuple(views[v].select(*fs) for v, fs in grouped.items())


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


#: Buckets that one window partition of the prefix scan takes together.
FAN_OUT = 512
SCAN_LEVELS = 2


def _block(pos: Column, fan_out: int) -> Column:
    """floor(pos / fan_out) in whole numbers."""
    return ((pos - F.pmod(pos, F.lit(fan_out))) / fan_out).cast("bigint")


def carried_in(summary: DataFrame, keys: list[str], newest: list[str], fan_out: int = FAN_OUT, levels: int = SCAN_LEVELS) -> DataFrame:
    """For each asked (key, __pos) of ``summary`` the last non-NULL value of every column of ``newest`` at smaller positions.

    ``summary`` has one row per (key, __pos) with ``__asked`` and the ``newest`` columns. A prefix scan in levels: positions are
    folded into blocks of ``fan_out``, blocks into blocks of blocks (partial ``max_by`` aggregates), a running ``last`` goes over the
    topmost blocks of a key, and what each block has before it enters the window over its own positions as a first row. So
    no window partition holds more than ``fan_out`` + 1 rows below the top, nor more than a key's positions / fan_out^(levels - 1) there.
    """
    steps = [summary.select(*keys, "__pos", "__asked", *newest)]
    for _ in range(max(1, levels) - 1):
        held = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col("__in"))).alias(n) for n in newest]
        steps.append(steps[-1].withColumnRenamed("__pos", "__in").groupBy(*keys, _block(F.col("__in"), fan_out).alias("__pos"))
                     .agg(F.max("__asked").alias("__asked"), *held))

    def before(rows: DataFrame, within: list[str], order: list[str]) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(*[c for c in rows.columns if c not in newest], *[F.last(n, ignorenulls=True).over(w).alias(n) for n in newest])

    carry = before(steps[-1], keys, ["__pos"]).filter("__asked").drop("__asked")
    for step in reversed(steps[:-1]):
        opening = carry.select(*keys, F.col("__pos").alias("__block"), F.lit(None).cast("bigint").alias("__pos"), F.lit(False).alias("__asked"), *newest)
        rows = step.withColumn("__block", _block(F.col("__pos"), fan_out)).unionByName(opening)
        carry = before(rows, [*keys, "__block"], ["__pos"]).filter("__asked").drop("__asked", "__block")
    return carry.filter(reduce(or_, [F.col(n).isNotNull() for n in newest]))


def point_in_time_views(entities: DataFrame, sources: dict[str, DataFrame], wanted: list[tuple[FeatureView, tuple[str, ...]]],
                        entity_ts: str = "event_timestamp", buckets_per_ttl: int = 4, full_names: bool = False,
                        hot_rows: int | None = 2_000_000, bucket_width=None) -> DataFrame:
    """Leakage-free as-of left join with TTL of several views of one key. Keeps every entity row exactly once.

    Time is cut into buckets (the smallest TTL/k with k = ``buckets_per_ttl``, or ``bucket_width`` when no view has a TTL). The
    newest row of a view at or before an entity time t is either in t's own bucket or is the newest row of all earlier
    buckets of that key. So:

    1. one partial aggregate gives the newest row of each view per non-empty (key, bucket), and whether entity rows lie there;
    2. ``carried_in`` gives each bucket with entity rows the newest row of every view in all earlier buckets of the key;
    3. the main window over (key, bucket): own feature rows, the carry row and the entity rows, ``last(ignorenulls)`` per view ordered by
       (time, side, created), then each view's TTL check (``t - ttl <= ts <= t``).

    The entity frame is shuffled once, however many views there are. A key with more than ``hot_rows`` rows on either side
    gets m = ceil(rows / hot_rows) times finer buckets, so a key holding a third of all rows is spread over many window partitions.
    The table of such keys has at most rows / hot_rows entries (a few hundred thousand small rows for 10^12 rows), which is why it may be
    broadcast. ``hot_rows`` changes the partitions only, never a row of the result. NULL keys match nothing; their entity
    rows are dealt out by content. Feature rows without a time are never met.
    """
    keys = list(wanted[0][0].keys)
    if any(list(v.keys) != keys for v, _ in wanted):
        raise ValueError("views of different keys")
    ent_cols = entities.columns
    ttls = [v.ttl for v, _ in wanted if v.ttl is not None]
    base = max(1, int(min(ttls) / timedelta(microseconds=1)) // max(1, int(buckets_per_ttl))) if ttls else \
        max(1, int((bucket_width or timedelta(days=1)) / timedelta(microseconds=1)))
    known = [F.col(c).isNotNull() for c in keys]
    slots = [f"__f{i}" for i in range(len(wanted))]

    entity_kind = entities.select(F.struct(*[F.col(c) for c in ent_cols]).alias("e")).schema["e"].dataType
    held = [sources[v.name].select(F.struct(F.col(v.timestamp_field).cast("timestamp_ntz").alias("__ts"), *[F.col(f) for f in fs]).alias("f"))
            .schema["f"].dataType for v, fs in wanted]

    def side(frame: DataFrame, t: Column, created: Column, number: int, values: dict) -> DataFrame:
        return frame.select(*keys, t.alias("__t"), F.lit(number).alias("__side"), created.alias("__created"),
                            *[values.get(n, F.lit(None).cast(kind)).alias(n) for n, kind in [("__e", entity_kind), *zip(slots, held)]])

    parts = [side(entities, F.col(entity_ts).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"), _SIDE_ENTITY,
                  {"__e": F.struct(*[F.col(c) for c in ent_cols])})]
    for slot, (v, fs) in zip(slots, wanted):
        t = F.col(v.timestamp_field).cast("timestamp_ntz")
        created = F.col(v.created_field).cast("timestamp_ntz") if v.created_field else F.lit(None).cast("timestamp_ntz")
        parts.append(side(sources[v.name].filter(reduce(and_, [*known, t.isNotNull()])), t, created, _SIDE_FEATURE,
                          {slot: F.struct(t.alias("__ts"), *[F.col(f) for f in fs])}))
    rows = reduce(DataFrame.unionAll, parts)

    width = F.lit(base)
    if hot_rows:
        tall = [F.count_if(F.col("__side") == n) for n in (_SIDE_FEATURE, _SIDE_ENTITY)]
        hot = (rows.filter(reduce(and_, known)).groupBy(*keys).agg(F.greatest(*tall).alias("__n")).filter(F.col("__n") > hot_rows)
               .select(*keys, F.ceil(F.col("__n") / F.lit(hot_rows)).cast("bigint").alias("__m")))
        rows = rows.join(F.broadcast(hot), keys, "left")
        width = F.greatest(F.floor(F.lit(base) / F.coalesce(F.col("__m"), F.lit(1).cast("bigint"))), F.lit(1))
    # entity rows of a NULL key meet no feature rows: dealt out by their content, not into one window partition
    place = F.when(reduce(and_, known), F.floor(_micros(F.col("__t")) / width)).otherwise(F.xxhash64("__e")).cast("bigint")
    rows = rows.withColumn("__pos", place).drop("__m")

    at = F.struct("__t", "__created")
    summary = rows.filter(reduce(and_, known) & F.col("__pos").isNotNull()).groupBy(*keys, "__pos").agg(
        F.max(F.col("__side") == _SIDE_ENTITY).alias("__asked"),
        *[F.max_by(n, F.when(F.col(n).isNotNull(), at)).alias(n) for n in slots])
    carry = carried_in(summary, keys, slots).select(
        *keys, F.lit(None).cast("timestamp_ntz").alias("__t"), F.lit(_SIDE_FEATURE).alias("__side"), F.lit(None).cast("timestamp_ntz").alias("__created"),
        F.lit(None).cast(entity_kind).alias("__e"), *slots, "__pos")

    w = (Window.partitionBy(*keys, "__pos").orderBy("__t", "__side", "__created")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = rows.unionByName(carry).select("__side", "__t", "__e", *[F.last(n, ignorenulls=True).over(w).alias(n) for n in slots])
    met = met.filter(F.col("__side") == _SIDE_ENTITY)
    out = [F.col("__e." + c).alias(c) for c in ent_cols]
    for slot, (v, fs) in zip(slots, wanted):
        fresh = F.col(f"{slot}.__ts") >= F.col("__t") - F.lit(v.ttl) if v.ttl is not None else F.col("__t").isNotNull()
        out += [F.when(fresh, F.col(f"{slot}.{f}")).alias(f"{v.name}__{f}" if full_names else f) for f in fs]
    return met.select(*out)


def point_in_time_join(entities: DataFrame, source: DataFrame, view: FeatureView,
                       features: tuple[str, ...] | None = None, entity_ts: str = "event_timestamp",
                       buckets_per_ttl: int = 4, full_names: bool = False,
                       hot_rows: int | None = 2_000_000, bucket_width=None) -> DataFrame:
    """``point_in_time_views`` for one view."""
    return point_in_time_views(entities, {view.name: source}, [(view, tuple(features or view.features))], entity_ts,
                               buckets_per_ttl, full_names, hot_rows, bucket_width)


def latest_per_key(source: DataFrame, view: FeatureView, start=None, end=None) -> DataFrame:
    """Newest row per key with event time in ``(start, end]`` ordered by (event, created).

    A partial aggregate (``max_by``), so a hot key costs one buffer per task.
    """
    ts, created = view.timestamp_field, view.created_field
    src = source
    if start is not None:
        src = src.filter(F.col(ts) > F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        src = src.filter(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    cols = [ts] + ([created] if created else []) + list(view.features)
    order = F.struct(F.col(ts), F.col(created)) if created else F.col(ts)
    row = F.struct(*[F.col(c) for c in cols])
    return src.groupBy(*view.keys).agg(F.max_by(row, order).alias("__r")).select(
        *view.keys, *[F.col("__r." + c).alias(c) for c in cols])


def batch_scoring_features(entities: DataFrame, source: DataFrame, view: FeatureView, as_of,
                           features: tuple[str, ...] | None = None, entity_ts: str = "event_timestamp") -> DataFrame:
    """J1 with every entity time set to ``as_of``; equals latest-per-key within TTL.

    One partial aggregate over the source plus one equi-join (one row per key on
    the feature side, so no row blow-up; AQE splits a skewed entity side).
    """
    features = tuple(features or view.features)
    at = F.lit(as_of).cast("timestamp_ntz")
    latest = latest_per_key(source, view, end=as_of)
    if view.ttl is not None:
        latest = latest.filter(F.col(view.timestamp_field) >= at - F.lit(view.ttl))
    latest = latest.select(*view.keys, *features)
    ent = entities.withColumn(entity_ts, at)
    return ent.join(latest, list(view.keys), "left").select(*entities.columns, *features)


def merge_latest(current: DataFrame | None, updates: DataFrame, view: FeatureView) -> DataFrame:
    """Merge rows into an online table (one row per key), newest (event, created) wins."""
    cols = list(view.keys) + [view.timestamp_field] + ([view.created_field] if view.created_field else []) \
        + list(view.features)
    both = updates.select(*cols) if current is None else current.select(*cols).unionByName(updates.select(*cols))
    return latest_per_key(both, view)


def materialize_incremental(online: DataFrame | None, source: DataFrame, view: FeatureView, last_end, end) -> DataFrame:
    """Fold the source rows in ``(last_end, end]`` into the online table."""
    return merge_latest(online, latest_per_key(source, view, start=last_end, end=end), view)


def push(offline: DataFrame, online: DataFrame | None, rows: DataFrame, view: FeatureView) -> tuple[DataFrame, DataFrame]:
    """Append pushed rows to the offline history and merge them into the online table."""
    cols = offline.columns
    new_offline = offline.unionByName(rows.select(*cols))
    return new_offline, merge_latest(online, rows, view)


def online_lookup(entity_rows: DataFrame, online: DataFrame, view: FeatureView,
                  features: tuple[str, ...] | None = None) -> DataFrame:
    """Left-join request rows to the online table; unknown keys give NULLs.

    Output feature columns are sorted by name.
    """
    features = tuple(sorted(features or view.features))
    table = online.select(*view.keys, *features)
    return entity_rows.join(table, list(view.keys), "left").select(*entity_rows.columns, *features)


def apply_on_demand(df: DataFrame, odfv: OnDemandView, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Add on-demand columns computed from view fields and request columns."""
    cols = odfv.columns()
    fields = fields or odfv.outputs
    return df.select("*", *[cols[f].alias(f) for f in fields])


def _refs(items: tuple) -> list:
    """Views stand for all their fields."""
    whole = lambda it: it.select(*it.features) if isinstance(it, FeatureView) else it.select(*it.outputs)
    return [whole(it) if isinstance(it, (FeatureView, OnDemandView)) else it for it in items]


def _resolved(items: tuple) -> tuple[dict[str, tuple[FeatureView, list[str]]], list[tuple[OnDemandView, tuple[str, ...]]]]:
    """The views to read, each with its fields (also those that only on-demand views need), and the on-demand views."""
    needed: dict[str, tuple[FeatureView, list[str]]] = {}
    od: list[tuple[OnDemandView, tuple[str, ...]]] = []
    for ref in _refs(items):
        reads = [(ref.view, ref.fields)]
        if isinstance(ref, OnDemandRef):
            od.append((ref.view, ref.fields))
            reads = [(s, s.features) for s in ref.view.sources if isinstance(s, FeatureView)]
        for v, fields in reads:
            fs = needed.setdefault(v.name, (v, []))[1]
            fs += [f for f in fields if f not in fs]
    return needed, od


def _checked_requests(rows: DataFrame, od: list[tuple[OnDemandView, tuple[str, ...]]]) -> DataFrame:
    """The caller's frame carries what the on-demand views read, in the declared types."""
    for odfv, _ in od:
        missing = [s for s in odfv.sources if isinstance(s, str) and s not in rows.columns]
        if missing:
            raise ValueError(f"{odfv.name} misses request columns {missing}")
        for s in odfv.sources:
            if isinstance(s, RequestSource):
                rows = s.check(rows)
    return rows


def _on_demand(out: DataFrame, od: list, full_names: bool) -> DataFrame:
    """Add the on-demand columns; their code reads plain field names, also where the frame holds ``<view>__<field>``."""
    for odfv, fs in od:
        if not full_names:
            out = apply_on_demand(out, odfv, fs)
            continue
        before = out.columns
        plain = {f: F.col(f"{s.name}__{f}") for s in odfv.sources if isinstance(s, FeatureView) for f in s.features}
        out = out.select("*", *[c.alias(f) for f, c in plain.items() if f not in before])
        out = apply_on_demand(out, odfv, fs).select(*before, *fs)
    return out


def historical_features(entities: DataFrame, sources: dict, items: tuple, entity_ts: str = "event_timestamp",
                        buckets_per_ttl: int = 4, full_names: bool = False) -> DataFrame:
    """Assemble views and on-demand views for an entity frame (training set).

    ``sources`` maps a view name to its source frame. All views of one key are retrieved in one pass
    (``point_in_time_views``), so the entity frame is shuffled once per key, not per view; on-demand views are computed
    last, after their request sources have cast and checked the entity frame. The on-demand inputs that are not
    requested are fetched and dropped again.
    ``full_names=True`` names view fields ``<view>__<field>`` so that views sharing
    field names can be combined (on-demand views then read the prefixed names).
    """
    needed, od = _resolved(items)
    out = _checked_requests(entities, od)
    wanted: list[str] = list(entities.columns)
    for ref in _refs(items):
        wanted += [f"{ref.view.name}__{f}" if full_names and isinstance(ref, FeatureRef) else f for f in ref.fields]
    clash = [n for n in set(wanted) if wanted.count(n) > 1]
    if clash:
        raise ValueError(f"feature names clash: {sorted(clash)}")
    by_key: dict[tuple[str, ...], list] = {}
    for view, fs in needed.values():
        by_key.setdefault(tuple(view.keys), []).append((view, tuple(fs)))
    for group in by_key.values():
        out = point_in_time_views(out, sources, group, entity_ts, buckets_per_ttl, full_names=full_names)
    out = _on_demand(out, od, full_names)
    return out.select(*wanted)


def online_features(entity_rows: DataFrame, online: dict, items: tuple, full_names: bool = False) -> DataFrame:
    """J3 + J4 for serving: look up view fields in online tables, then on-demand fields.

    ``online`` maps a view name to its online table (one row per key). Returned
    feature columns are sorted by name, after the request columns (L5). Views that share field names need
    ``full_names``: view fields are then called ``<view>__<field>``. Request sources cast and check the request rows first (S4).
    """
    needed, od = _resolved(items)
    out = _checked_requests(entity_rows, od)
    name = lambda v, f: f"{v.name}__{f}" if full_names else f
    wanted = [name(r.view, f) if isinstance(r, FeatureRef) else f for r in _refs(items) for f in r.fields]
    fetched = [name(v, f) for v, fs in needed.values() for f in fs]
    clash = sorted({n for n in wanted if wanted.count(n) > 1 or n in entity_rows.columns} | {n for n in fetched if fetched.count(n) > 1})
    if clash:
        raise ValueError(f"feature names clash: {clash}")
    for vname, (view, fs) in needed.items():
        table = online[vname].select(*view.keys, *[F.col(f).alias(name(view, f)) for f in fs])
        out = out.join(table, list(view.keys), "left").select(*out.columns, *[name(view, f) for f in fs])
    out = _on_demand(out, od, full_names)
    return out.select(*entity_rows.columns, *sorted(wanted))


def log_served(served: DataFrame, service: str, served_at, path: str) -> None:
    """Append served feature rows with the service name and serving time (partitioned by service)."""
    (served.select("*", F.lit(service).alias("feature_service"),
                   F.lit(served_at).cast("timestamp_ntz").alias("served_at"))
     .write.mode("append").partitionBy("feature_service").parquet(path))


def apply_on_demand_pandas(df: DataFrame, fn, outputs: T.StructType) -> DataFrame:
    """F1 for opaque pandas code: ``fn(pandas.DataFrame) -> pandas.DataFrame`` of the ``outputs`` columns.

    Runs per Arrow batch with ``mapInPandas`` (no per-row Python); the result
    columns are appended to the input row. Prefer ``OnDemandView`` (Column
    expressions, stays in codegen) when the transform can be written that way.
    """
    out_schema = T.StructType(df.schema.fields + outputs.fields)
    names = [f.name for f in outputs.fields]

    def run(batches):
        for pdf in batches:
            res = fn(pdf)
            for n in names:
                pdf[n] = res[n].values
            yield pdf

    return df.mapInPandas(run, out_schema)
