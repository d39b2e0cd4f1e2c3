"""The model DAG (R13, K1-K6): build all ten models, as DataFrames or tables.

Build order follows the reads of each model:

    dim.date                    (generated)
    dim.pool                    src.pool
    dim.block                   src.block
    fact.price_1d               src.price, dim.date
    fact.block                  src.block, dim.date, dim.block, dim.pool
    fact.network_stats_1d       src.block, dim.date
    fact.pool_stats_1d          src.block, src.hashrate, dim.date, dim.pool
    obt.block                   fact.block, dim.block, dim.date, dim.pool
    obt.network_stats_1d        fact.network_stats_1d, fact.price_1d, dim.date
    obt.pool_stats_1d           fact.pool_stats_1d, fact.network_stats_1d, fact.price_1d,
                                dim.date, dim.pool
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainstar.operators.chain import without_stale
from chainstar.operators.preview import PREVIEW_ROWS, preview
from chainstar.operators.sinks import create_view, write_checked, write_table
from chainstar.plans import dims, facts, obts, views

DAG: dict[str, tuple[str, ...]] = {
    "dim.date": (),
    "dim.pool": ("src.pool",),
    "dim.block": ("src.block",),
    "fact.price_1d": ("src.price", "dim.date"),
    "fact.block": ("src.block", "dim.date", "dim.block", "dim.pool"),
    "fact.network_stats_1d": ("src.block", "dim.date"),
    "fact.pool_stats_1d": ("src.block", "src.hashrate", "dim.date", "dim.pool"),
    "obt.block": ("fact.block", "dim.block", "dim.date", "dim.pool"),
    "obt.network_stats_1d": ("fact.network_stats_1d", "fact.price_1d", "dim.date"),
    "obt.pool_stats_1d": ("fact.pool_stats_1d", "fact.network_stats_1d", "fact.price_1d",
                          "dim.date", "dim.pool"),
}

# Row-grain keys of each model (README grains), used by the unique-key checks.
GRAIN = {
    "dim.date": ["date_id"], "dim.pool": ["pool_id"], "dim.block": ["block_id"],
    "fact.price_1d": ["date_id"], "fact.block": ["block_id"],
    "fact.network_stats_1d": ["date_id"], "fact.pool_stats_1d": ["date_id", "pool_id"],
    "obt.block": ["block_id"], "obt.network_stats_1d": ["date_id"],
    "obt.pool_stats_1d": ["date_id", "pool_id"],
}

# Conditions that rows of a model meet, counted as it is written.
RULES = {
    "fact.price_1d": {"low_to_high": "price_low <= price_high"},
    "fact.block": {"reward_is_sum": "reward_mining = reward_subsidy + reward_tx_fee_sum", "tx_count_positive": "tx_count > 0"},
    "fact.network_stats_1d": {"heights_ordered": "blockheight_first <= blockheight_last",
                              "pools_within_blocks": "pool_count <= block_count"},
    "fact.pool_stats_1d": {"heights_ordered": "blockheight_first <= blockheight_last"},
}

# Sort order inside written files (K4): min/max statistics then prune reads
# that filter on these columns.
SORT_WITHIN = {"dim.date": ["date_id"], "fact.block": ["date_id", "blockheight"],
               "fact.network_stats_1d": ["date_id"], "fact.pool_stats_1d": ["date_id"],
               "fact.price_1d": ["date_id"]}

# Preview order of each model (O1, O2).
PREVIEW_ORDER = {
    "dim.pool": ["pool_key"], "dim.block": ["block_key"], "fact.price_1d": ["date_id"],
    "fact.block": ["blockheight"], "fact.network_stats_1d": ["date_id"],
    "fact.pool_stats_1d": ["date_id", "-block_count"], "obt.block": ["blockheight"],
    "obt.network_stats_1d": ["event_date"],
    "obt.pool_stats_1d": ["event_date", "-block_count", "pool_name"],
}


def preview_model(marts: "Marts", name: str, k: int = PREVIEW_ROWS) -> DataFrame:
    """O1/O2: the reference's preview of a model (``order by ... limit 1000``).

    Add a unique key to the order for a repeatable result (ties are possible).
    """
    return preview(marts[name], PREVIEW_ORDER[name], k)


def descendants(changed: Iterable[str]) -> list[str]:
    """K6: models to rebuild after ``changed`` (sources or models), in DAG order."""
    dirty = set(changed)
    out = []
    for name, reads in DAG.items():
        if name in dirty or dirty.intersection(reads):
            dirty.add(name)
            out.append(name)
    return out


class Marts:
    """Lazily built models over a dict of source DataFrames.

    Each model is defined once and shared by its readers, so one Spark plan
    serves e.g. ``fact.block``, ``dim.block`` and both daily facts from the
    same deduped blocks.  ``reuse(name, df)`` swaps in a materialised table.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame], run_ts=None,
                 strict: bool = True, collapse_unknown: bool = False, persist_shared: bool = True,
                 chain_path: str | None = None):
        """``chain_path``: a shared folder; blocks off the canonical chain are then left out of all models."""
        self.spark = spark
        self.persist_shared = persist_shared
        self._persisted: list[DataFrame] = []
        self.sources = dict(sources)
        self.run_ts = run_ts
        self.strict = strict
        self.collapse_unknown = collapse_unknown
        self.chain_path = chain_path
        self._cache: dict[str, DataFrame] = {}
        self._materialised: set[str] = set()

    def reuse(self, name: str, df: DataFrame) -> None:
        self._cache[name] = df
        self._materialised.add(name)

    def _shared(self, df: DataFrame) -> DataFrame:
        """Persist an intermediate read by several models (memory, spilling to
        disk).  Lost partitions are recomputed from lineage, so executor loss
        is survived.  Only small day- or dimension-grain data is persisted."""
        if not self.persist_shared:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(df)
        return df

    def release(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()

    @property
    def blocks(self) -> DataFrame:
        if "stage.block" not in self._cache:
            blocks = dims.staged_blocks(self.sources["block"], self.run_ts)
            if self.chain_path is not None:
                # Read several times by the chain's rounds: dedupe once.
                path = f"{self.chain_path.rstrip('/')}/blocks"
                write_table(blocks, path=path)
                blocks = without_stale(self.spark.read.schema(blocks.schema).parquet(path), self.chain_path)
            self._cache["stage.block"] = blocks
        return self._cache["stage.block"]

    @property
    def cube(self) -> DataFrame:
        """The daily pre-aggregate both daily facts roll up."""
        if "stage.cube" not in self._cache:
            self._cache["stage.cube"] = self._shared(facts.block_cube(self.blocks))
        return self._cache["stage.cube"]

    @property
    def network_daily(self) -> DataFrame:
        """Day grain with the weighted difficulty, read by both daily facts."""
        if "stage.network_daily" not in self._cache:
            self._cache["stage.network_daily"] = self._shared(facts.network_daily(self.cube))
        return self._cache["stage.network_daily"]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def _build(self, name: str) -> DataFrame:
        s, r = self.sources, self.run_ts
        if name == "dim.date":
            return dims.calendar(self.spark)
        if name == "dim.pool":
            return self._shared(dims.dim_pool(s["pool"], r))
        if name == "dim.block":
            return dims.dim_block(self.blocks)
        if name == "fact.price_1d":
            return facts.fact_price_1d(s["price"], self["dim.date"], run_ts=r)
        if name == "fact.block":
            return facts.fact_block(self.blocks, self["dim.date"], self["dim.pool"],
                                    strict=self.strict)
        if name == "fact.network_stats_1d":
            return facts.fact_network_stats_1d(self.blocks, self["dim.date"], cube=self.cube,
                                               daily=self.network_daily, strict=self.strict)
        if name == "fact.pool_stats_1d":
            return facts.fact_pool_stats_1d(self.blocks, s["hashrate"], self["dim.date"],
                                            self["dim.pool"], self.collapse_unknown, cube=self.cube,
                                            daily=self.network_daily, strict=self.strict)
        if name == "obt.block" and not self._materialised & {"fact.block", "dim.block"}:
            return obts.obt_block_of(self.blocks, self["dim.date"], self["dim.pool"], self.strict)
        if name == "obt.block":
            return obts.obt_block(self["fact.block"], self["dim.block"], self["dim.date"],
                                  self["dim.pool"])
        if name == "obt.network_stats_1d":
            return obts.obt_network_stats_1d(self["fact.network_stats_1d"], self["fact.price_1d"],
                                             self["dim.date"])
        if name == "obt.pool_stats_1d":
            return obts.obt_pool_stats_1d(self["fact.pool_stats_1d"],
                                          self["fact.network_stats_1d"], self["fact.price_1d"],
                                          self["dim.date"], self["dim.pool"], self.strict)
        raise KeyError(name)


def build(marts: Marts, base_path: str, names: Iterable[str] | None = None,
          obt_as_view: bool = True, block_buckets: int | None = None,
          use_catalog: bool = False) -> dict[str, DataFrame]:
    """K1/K2/K3: materialise models under ``base_path`` in DAG order.

    The deduped blocks are written once as a staging table read by all block
    models.  Dims and facts are written as Parquet (full rebuild); each one
    read back replaces its plan, so downstream models read the table, not
    the lineage (which also bounds recomputation after executor loss).
    OBTs become views (K2) unless ``obt_as_view=False`` (K3): lasting views of the catalog
    where all the tables they read are written to it here, else views of the session.
    With ``block_buckets`` and ``use_catalog`` both block tables are bucketed
    by ``block_id`` so that ``obt.block`` joins them without a shuffle.
    """
    spark = marts.spark
    wanted = list(DAG) if names is None else [n for n in DAG if n in set(names)]
    out = {}
    block_models = {"dim.block", "fact.block", "fact.network_stats_1d", "fact.pool_stats_1d"}
    if block_models.intersection(wanted):
        # The deduped blocks feed four models: dedupe (the one big shuffle)
        # once, write it as a staging table, and let every model read that.
        stage_path = f"{base_path.rstrip('/')}/stage/block"
        write_table(marts.blocks, path=stage_path)
        marts.reuse("stage.block", spark.read.parquet(stage_path))
    for name in wanted:
        if name.startswith("obt.") and obt_as_view:
            if use_catalog and set(DAG[name]) <= set(out):
                out[name] = views.create_lasting_view(spark, name, marts.strict)
            else:
                out[name] = create_view(marts[name], name)
            continue
        df = marts[name]
        path = f"{base_path.rstrip('/')}/{name.replace('.', '/')}"
        bucket = None
        if block_buckets and use_catalog and name in ("fact.block", "dim.block"):
            bucket = (block_buckets, ["block_id"])
        sort = [] if bucket else SORT_WITHIN.get(name, [])
        if use_catalog:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
            write_table(df, name=name, path=path, bucket_by=bucket, sort_within=sort)
            table = spark.table(name)
        else:
            write_table(df, path=path, sort_within=sort)
            table = spark.read.parquet(path)
        marts.reuse(name, table)
        out[name] = table
    return out


def checked_build(marts: Marts, base_path: str) -> dict[str, dict[str, int]]:
    """E6 on write: every model but the generated calendar is written under ``base_path`` in DAG
    order, and counts of its rows and of what breaks its rules come from the writes' own jobs."""
    spark, base = marts.spark, base_path.rstrip("/")
    write_table(marts.blocks, path=f"{base}/stage/block")
    marts.reuse("stage.block", spark.read.parquet(f"{base}/stage/block"))
    out = {}
    for name in DAG:
        if name == "dim.date":
            continue
        df, path = marts[name], f"{base}/{name.replace('.', '/')}"
        rules = {rule: F.expr(ok) for rule, ok in RULES.get(name, {}).items()}
        out[name] = write_checked(df, GRAIN[name], GRAIN[name], rules, path=path)
        marts.reuse(name, spark.read.schema(df.schema).parquet(path))
    return out
