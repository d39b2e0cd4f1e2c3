"""The wide tables as lasting views (K2), and drops in the order of their readers (K6).

Each view is SQL over the written ``fact`` and ``dim`` tables, so every session of the
catalog reads it and each read computes it anew.  Its measures are SQL functions of
the ``obt`` schema with the exact arithmetic of ``functions.measures``: integral operands,
one rounding half away from zero.  The tables that a view reads are recorded in its
``reads`` property.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from chainstar.functions.measures import SECONDS_PER_DAY, TWO_POW_32
from chainstar.operators.sinks import LAYERS, create_namespaces
from chainstar.operators.star import SPREAD
from chainstar.plans.dims import POOL_DEFAULT
from chainstar.plans.obts import BLOCK_COLUMNS, DATE_ATTRS, NETWORK_COLUMNS, POOL_REWARD_COLUMNS

READS = {
    "obt.block": ("fact.block", "dim.block", "dim.date", "dim.pool"),
    "obt.network_stats_1d": ("fact.network_stats_1d", "fact.price_1d", "dim.date"),
    "obt.pool_stats_1d": ("fact.pool_stats_1d", "fact.network_stats_1d", "fact.price_1d", "dim.date", "dim.pool"),
}

# name -> (parameters, result, body); a later one may use those before it.
FUNCTIONS = {
    # round(n / d) half away from zero; NULL where d is zero; a quotient past 32 digits raises.
    "round_div": ("n DECIMAL(38,0), d DECIMAL(38,0)", "DECIMAL(38,0)",
                  "CAST(sign(n) * sign(d) AS DECIMAL(1,0)) * CAST(((abs(n) * 2 + abs(d)) - (abs(n) * 2 + abs(d)) "
                  "% nullif(abs(d) * 2, 0)) / nullif(abs(d) * 2, 0) AS DECIMAL(38,0))"),
    # units * 10^-9, in two exact steps (one product would be typed with a cut scale).
    "nano": ("units DECIMAL(38,0)", "DECIMAL(30,9)",
             "CAST(CAST(CAST(units AS DECIMAL(30,0)) * CAST('0.0000001' AS DECIMAL(7,7)) AS DECIMAL(30,7)) "
             "* CAST('0.01' AS DECIMAL(2,2)) AS DECIMAL(30,9))"),
    # Price by amount; 18 digits of price leave room for the exact product.
    "usd": ("price DECIMAL(18,2), btc DECIMAL(19,11)", "DECIMAL(21,6)", "CAST(price * btc AS DECIMAL(21,6))"),
    "hashvalue_th": ("reward BIGINT, rate DECIMAL(30,12)", "DECIMAL(30,9)",
                     "obt.nano(obt.round_div(CAST(reward AS DECIMAL(19,0)) * CAST('1{21}' AS DECIMAL(22,0)), "
                     "CAST(rate * CAST('1{12}' AS DECIMAL(13,0)) AS DECIMAL(38,0))))"),
    "hashvalue_ph": ("reward BIGINT, rate DECIMAL(30,15)", "DECIMAL(30,9)",
                     "obt.nano(obt.round_div(CAST(reward AS DECIMAL(19,0)) * CAST('1{24}' AS DECIMAL(25,0)), "
                     "CAST(rate * CAST('1{15}' AS DECIMAL(16,0)) AS DECIMAL(38,0))))"),
    "hashprice": ("price DECIMAL(18,2), value DECIMAL(30,9)", "DECIMAL(30,9)",
                  "obt.nano(obt.round_div(CAST(price * 100 AS DECIMAL(38,0)) * CAST(value * CAST('1{9}' AS DECIMAL(10,0)) "
                  "AS DECIMAL(38,0)), CAST('1{10}' AS DECIMAL(11,0))))"),
    "expected_blocks": ("reported DECIMAL(30,9), difficulty DECIMAL(30,9)", "DOUBLE",
                        f"CAST(reported * CAST({SECONDS_PER_DAY} AS DECIMAL(5,0)) / difficulty AS DOUBLE) / {TWO_POW_32:.0f}D"),
    "luck_diff_pct": ("n INT, expected DECIMAL(21,9)", "DECIMAL(30,9)",
                      "obt.nano(obt.round_div((CAST(n AS DECIMAL(10,0)) * CAST('1{11}' AS DECIMAL(12,0)) "
                      "- CAST(expected * CAST('1{9}' AS DECIMAL(10,0)) AS DECIMAL(38,0))) * CAST('1{9}' AS DECIMAL(10,0)), "
                      "CAST(expected * CAST('1{9}' AS DECIMAL(10,0)) AS DECIMAL(38,0))))"),
    "luck": ("n INT, expected DECIMAL(21,9)", "DECIMAL(30,9)",
             "obt.nano(obt.round_div(CAST(n AS DECIMAL(10,0)) * CAST('1{20}' AS DECIMAL(21,0)), "
             "CAST(expected * CAST('1{9}' AS DECIMAL(10,0)) AS DECIMAL(38,0))))"),
}


def _zeros(body: str) -> str:
    """``1{k}`` written out as a power of ten."""
    for k in range(1, 31):
        body = body.replace("1{%d}" % k, "1" + "0" * k)
    return body


def create_functions(spark: SparkSession) -> None:
    create_namespaces(spark, ["obt"])
    for name, (params, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE FUNCTION obt.{name}({params}) RETURNS {result} RETURN {_zeros(body)}")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value).lower()


def _pool(column: str) -> str:
    """A pool attribute; rows of the default member have its values as literals."""
    return f"CASE WHEN f.pool_id = '0' THEN {_literal(POOL_DEFAULT.get(column))} ELSE p.{column} END AS {column}"


def _pool_join(spread: str) -> str:
    """The pool dimension, joined without the default member: its many rows are spread over keys that match nothing."""
    return (f"LEFT JOIN dim.pool p ON p.pool_id <> '0' AND p.pool_id = CASE WHEN f.pool_id = '0' "
            f"THEN concat('~', pmod(xxhash64({spread}), {SPREAD})) ELSE f.pool_id END")


def _select(columns: Iterable[str], computed: dict[str, str], sources: dict[str, Iterable[str]]) -> str:
    """``columns`` in order: computed ones by their SQL, others from the first source that has them."""
    out = []
    for c in columns:
        if c in computed:
            out.append(computed[c])
        else:
            out.append(f"{next(a for a, cols in sources.items() if c in cols)}.{c}")
    return ",\n  ".join(out)


def _dates() -> dict[str, str]:
    return {"event_date": "d.date AS event_date"} | {c: f"d.{c}" for c in DATE_ATTRS}


def _usd(*names: str) -> list[str]:
    return [f"obt.usd(c.price_close, {t}.{n}_btc) AS {n}_usd" for t, n in (x.split(".") for x in names)]


def _block_sql(spark: SparkSession, strict: bool) -> str:
    pool = [c for c in spark.table("dim.pool").columns if c not in ("pool_id", "audit_created_timestamp")]
    sources = {"f": spark.table("fact.block").columns, "b": spark.table("dim.block").columns}
    return f"""SELECT /*+ BROADCAST(d) */
  {_select(BLOCK_COLUMNS, _dates() | {c: _pool(c) for c in pool}, sources)}
FROM fact.block f JOIN dim.block b ON b.block_id = f.block_id JOIN dim.date d ON d.date_id = f.date_id
{_pool_join('f.block_id')}
WHERE f.pool_id = '0' OR p.pool_id IS NOT NULL"""


def _network_sql(spark: SparkSession, strict: bool) -> str:
    columns = ["n.date_id", *_dates().values(), "c.ticker", "c.price_close", *[f"n.{c}" for c in NETWORK_COLUMNS],
               *_usd("n.reward_mining_sum", "n.reward_subsidy_sum", "n.reward_tx_fee_sum"),
               "n.tx_fee_avg", "n.tx_fee_avg_btc", *_usd("n.tx_fee_avg"),
               *[f"obt.hashvalue_{u}(n.reward_mining_sum, n.estimated_hashrate_{u}) AS hashvalue_sat_{u}" for u in ("th", "ph")]]
    return f"""SELECT *, {', '.join(f'obt.hashprice(price_close, hashvalue_sat_{u}) AS hashprice_usd_{u}' for u in ('th', 'ph'))}
FROM (SELECT /*+ BROADCAST(c, d) */ {', '.join(columns)}
  FROM fact.network_stats_1d n JOIN fact.price_1d c ON c.date_id = n.date_id JOIN dim.date d ON d.date_id = n.date_id)"""


def _pool_sql(spark: SparkSession, strict: bool) -> str:
    pool = [c for c in spark.table("dim.pool").columns if c not in ("pool_id", "audit_created_timestamp")]
    rates = [f"{k}_hashrate{u}" for k in ("reported", "estimated") for u in ("", "_th", "_ph", "_eh")]
    # Types of the luck measures: as declared, or wide enough for every value.
    kind = {"expected": 21, "diff": 22, "pct": 30, "luck": 30}
    kind = {k: f"DECIMAL({12 if strict else p},9)" for k, p in kind.items()}
    base = ["f.date_id", *_dates().values(), "f.pool_id", *[_pool(c) for c in pool], *[f"f.{c}" for c in rates],
            f"CAST(obt.expected_blocks(f.reported_hashrate, n.difficulty_weighted_avg) AS {kind['expected']}) AS expected_block_count",
            "f.block_count"]
    rest = [f"f.{c}" for c in ("blockheight_first", "blockheight_last", *POOL_REWARD_COLUMNS)]
    rest += [*_usd("f.reward_mining_sum", "f.reward_subsidy_sum", "f.reward_tx_fee_sum"),
             "f.tx_fee_avg", "f.tx_fee_avg_btc", *_usd("f.tx_fee_avg")]

    def names(columns):
        return ", ".join(c.split(" AS ")[-1].split(".")[-1] for c in columns)

    # The unguarded quotients of the strict build raise; the lenient one gives NULL.
    e = "if(expected_block_count = 0, raise_error('DIVIDE_BY_ZERO'), expected_block_count)" if strict else "expected_block_count"
    return f"""SELECT {names(base)},
  CAST(CAST(block_count AS DECIMAL(10,0)) - expected_block_count AS {kind['diff']}) AS block_count_diff,
  CAST(obt.luck_diff_pct(block_count, {e}) AS {kind['pct']}) AS block_count_diff_pct,
  CAST(obt.luck(block_count, {e}) AS {kind['luck']}) AS mining_luck,
  {names(rest)}
FROM (SELECT /*+ BROADCAST(n, c, d) */ {', '.join([*base, *rest])}
  FROM fact.pool_stats_1d f JOIN fact.network_stats_1d n ON n.date_id = f.date_id
  JOIN fact.price_1d c ON c.date_id = f.date_id JOIN dim.date d ON d.date_id = f.date_id
  {_pool_join('f.date_id, f.blockheight_first')}
  WHERE f.pool_id = '0' OR p.pool_id IS NOT NULL)"""


SQL = {"obt.block": _block_sql, "obt.network_stats_1d": _network_sql, "obt.pool_stats_1d": _pool_sql}


def create_lasting_view(spark: SparkSession, name: str, strict: bool = True) -> DataFrame:
    """K2: the view ``name`` of the catalog, over tables that must have been written; the view, read."""
    create_functions(spark)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('reads' = '{','.join(READS[name])}') AS {SQL[name](spark, strict)}")
    return spark.table(name)


def recorded_reads(spark: SparkSession) -> dict[str, tuple[str, ...]]:
    """What each lasting view of the layers reads, from the catalog."""
    out = {}
    for layer in LAYERS:
        if not spark.catalog.databaseExists(layer):
            continue
        for v in spark.sql(f"SHOW VIEWS IN {layer}").filter("NOT isTemporary").collect():
            props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {layer}.{v.viewName}").collect()}
            if "reads" in props:
                out[f"{layer}.{v.viewName}"] = tuple(props["reads"].split(","))
    return out


def drop_model(spark: SparkSession, name: str, cascade: bool = False) -> list[str]:
    """K6: drop table or view ``name``, its recorded readers first; the names dropped, in order.

    Without ``cascade`` a model that a view reads is refused, as the reference's database does.
    """
    readers = [v for v, reads in recorded_reads(spark).items() if name in reads]
    if readers and not cascade:
        raise ValueError(f"{name} is read by {', '.join(readers)}")
    dropped = []
    for v in readers:
        if v not in dropped:
            dropped += drop_model(spark, v, cascade=True)
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"DROP {kind} {name}")
    return [*dropped, name]
