"""Snapshot-shaped views over the star-schema test tables.

Every expression is plain SQL, valid in Spark and in DuckDB, so one definition feeds both the
Spark views and the common table expressions of the oracle queries. Masses and positions are
small integers or dyadic fractions: their sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_SIM_LINEITEM = "case l_returnflag when 'A' then 'simA' when 'N' then 'simB' else 'simC' end"
_TTOT_LINEITEM = "cast((year(l_shipdate)-1995)*12+month(l_shipdate)-1 as double)"
_SIM_ORDERS = "case o_orderstatus when 'F' then 'simA' when 'O' then 'simB' else 'simC' end"
_TTOT_ORDERS = "cast((year(o_orderdate)-1995)*12+month(o_orderdate)-1 as double)"
_SIM_EVENTS = "case event_type when 'click' then 'simA' when 'view' then 'simB' else 'simC' end"

# name -> (source table, number of grouping columns, [(column, expression)])
ADAPTERS: dict[str, tuple[str, int, list[tuple[str, str]]]] = {
    "snapshot_singles": (
        "lineitem",
        3,
        [
            ("simulation_id", _SIM_LINEITEM),
            ("ttot", _TTOT_LINEITEM),
            ("object_id", "l_partkey"),
            ("kw", "cast(max((l_partkey*7+l_suppkey)%16)-1 as int)"),
            ("mass_msun", "max(l_quantity)*4"),
            ("x_pc", "max(cast(l_linenumber as double))-4"),
            ("y_pc", "max(cast(l_suppkey%9 as double))-4"),
            ("z_pc", "max(cast(l_orderkey%7 as double))-3"),
            ("vx_kms", "(max(cast(l_partkey%21 as double))-10)*0.0625"),
            ("vy_kms", "(max(cast(l_orderkey%19 as double))-9)*0.0625"),
            ("vz_kms", "(max(cast(l_suppkey%17 as double))-8)*0.0625"),
            ("radius_rsun", "max(cast(l_linenumber as double))*0.5"),
            ("luminosity_lsun", "max(l_extendedprice)"),
            ("teff_k", "max(cast(l_partkey%400 as double))*100+1000"),
        ],
    ),
    "snapshot_binaries": (
        "orders",
        4,
        [
            ("simulation_id", _SIM_ORDERS),
            ("ttot", _TTOT_ORDERS),
            ("object_id_1", "o_custkey"),
            ("object_id_2", "o_custkey+1+o_orderkey%3"),
            (
                "cm_id",
                "max(case when o_orderkey%11=0 then -o_orderkey when o_orderkey%11=1 "
                "then 100000+o_custkey else o_orderkey end)",
            ),
            ("kw_1", "cast(max(o_custkey%16)-1 as int)"),
            ("kw_2", "cast(max(o_orderkey%16)-1 as int)"),
            (
                "cm_kw",
                "cast(max(case when o_orderkey%13=0 then -1 when o_orderkey%17=0 then -25 "
                "else o_orderkey%16 end) as int)",
            ),
            (
                "bin_label",
                "cast(max(case o_orderkey%4 when 0 then 1 when 1 then 0 when 2 then -1 "
                "else -9 end) as int)",
            ),
            (
                "pert_gamma",
                "cast(max(case o_orderkey%5 when 0 then 0.0 when 1 then 0.1 else 0.5 end) "
                "as float)",
            ),
            ("mass_1_msun", "max(cast(o_orderkey%97+1 as double))*2"),
            ("mass_2_msun", "max(cast(o_custkey%31+1 as double))*0.5"),
            (
                "semi_major_axis_au",
                "max(cast(o_orderkey%1009+1 as double)*cast(case o_orderkey%5 when 0 "
                "then 1024.0 when 1 then 1.0 else 0.0009765625 end as double))",
            ),
            ("eccentricity", "max(cast(o_orderkey%64 as double))/64"),
            ("radius_1_rsun", "max(cast(o_orderkey%40+1 as double))*0.25"),
            ("radius_2_rsun", "max(cast(o_custkey%24+1 as double))*0.25"),
            ("teff_1_k", "max(cast(o_custkey%300 as double))*100+5000"),
            ("teff_2_k", "max(cast(o_orderkey%300 as double))*100+5000"),
            ("cm_x_pc", "max(cast(o_orderkey%9 as double))-4"),
            ("cm_y_pc", "max(cast(o_custkey%9 as double))-4"),
            ("cm_z_pc", "max(cast(o_orderkey%7 as double))-3"),
            ("cm_vx_kms", "(max(cast(o_custkey%21 as double))-10)*0.0625"),
            ("cm_vy_kms", "(max(cast(o_orderkey%19 as double))-9)*0.0625"),
            ("cm_vz_kms", "(max(cast(o_orderkey%17 as double))-8)*0.0625"),
            ("rel_x_pc", "(max(cast(o_orderkey%15 as double))-6)*0.125"),
            ("rel_y_pc", "(max(cast(o_custkey%13 as double))-7)*0.125"),
            ("rel_z_pc", "(max(cast(o_orderkey%5 as double))-2)*0.125"),
            ("rel_vx_kms", "(max(cast(o_custkey%11 as double))-4)*0.0625"),
            ("rel_vy_kms", "(max(cast(o_orderkey%23 as double))-12)*0.0625"),
            ("rel_vz_kms", "(max(cast(o_orderkey%3 as double))-1)*0.0625"),
        ],
    ),
    "snapshot_scalars": (
        "lineitem",
        2,
        [
            ("simulation_id", _SIM_LINEITEM),
            ("ttot", _TTOT_LINEITEM),
            ("rbar_pc", "cast(count(*)%2 as double)*2+2"),
            ("zmbar_msun", "cast(count(*)%2 as double)*4096+4096"),
            ("tscale_myr", "cast((count(*)+1)%2 as double)*0.25+0.25"),
            ("vstar_kms", "cast(count(*)%2 as double)*2+2"),
            ("ttot_over_tcr0", "cast(count(*)%16 as double)*0.5"),
            ("rdens_x_nb", "cast(count(*)%4 as double)*0.125"),
            ("rdens_y_nb", "cast(count(*)%3 as double)*0.125"),
            ("rdens_z_nb", "cast(0.0 as double)"),
            ("rc_nb", "cast(count(*)%8 as double)*0.0625"),
            ("nc", "count(*)%50"),
            ("eclose_nb", "cast(count(*)%5 as double)*0.25"),
            ("tidal_1", "cast(count(*)%2 as double)*0.25+0.25"),
            ("rg_x_pc", "cast(count(*)%100 as double)+4000"),
            ("rg_y_pc", "cast(count(*)%7 as double)*10"),
            ("rg_z_pc", "cast(count(*)%5 as double)-2"),
            ("vg_x_kmps", "cast(count(*)%11 as double)"),
            ("vg_y_kmps", "cast(count(*)%13 as double)+40"),
            ("vg_z_kmps", "cast(count(*)%3 as double)-1"),
            ("n", "count(*)"),
            ("n_single", "count(*)"),
            ("n_binary", "count(*)%37"),
        ],
    ),
    "merger_events": (
        "events",
        0,
        [
            ("simulation_id", _SIM_EVENTS),
            ("seq", "event_id"),
            (
                "ttot",
                "cast(case when event_id%10=9 then event_id-5 else event_id end as double)"
                "*0.0078125",
            ),
            ("parent_name_1", "user_id"),
            ("parent_name_2", "user_id+1+event_id%7"),
            ("parent_kw_1", "cast(event_id%16-1 as int)"),
            ("parent_kw_2", "cast((event_id*5)%16-1 as int)"),
            ("parent_mass_1_msun", "cast(event_id%181+1 as double)"),
            ("parent_mass_2_msun", "cast(event_id%53+1 as double)"),
            ("merger_type", "case when event_id%2=0 then 'collision' else 'coalescence' end"),
        ],
    ),
    # One row per snapshot per source file: restarted runs overlap, so a ttot has several files.
    "snapshot_steps": (
        "lineitem",
        4,
        [
            ("simulation_id", _SIM_LINEITEM),
            ("run_dir", "concat('run_', l_linestatus)"),
            (
                "filename_time",
                "cast(floor(((year(l_shipdate)-1995)*12+month(l_shipdate)-1)/8.0)*8 as double)",
            ),
            ("ttot", _TTOT_LINEITEM),
            ("n_star", "count(*)"),
            ("mtime", "max(cast(l_orderkey%1000 as double))"),
            ("size_bytes", "sum(cast(l_partkey as bigint))"),
        ],
    ),
}

# Views that have nearly as many groups as their source has rows.
ONE_ROW_GROUPS = ("snapshot_singles", "snapshot_binaries")


def adapter_sql(name: str) -> str:
    """SELECT text of one adapter view over its source table."""
    table, n_keys, columns = ADAPTERS[name]
    select = ", ".join(f"{expr} AS {alias}" for alias, expr in columns)
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(n_keys))}" if n_keys else ""
    return f"SELECT {select} FROM {table}{group}"


def adapter_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One snapshot-shaped table read from the parquet files below `sf_dir`."""
    table, n_keys, columns = ADAPTERS[name]
    source = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    if not n_keys:
        return source.selectExpr(*[f"{expr} AS {alias}" for alias, expr in columns])
    if name in ONE_ROW_GROUPS:
        # rows cross the shuffle as they are: sums made before it would hold nearly every row in memory, and be wider
        source = source.repartition(*[F.expr(expr) for _, expr in columns[:n_keys]])
    # groupBy().agg() wants aggregate columns only, so group on the aliased key expressions.
    keyed = source.selectExpr("*", *[f"{expr} AS {alias}" for alias, expr in columns[:n_keys]])
    return keyed.groupBy(*[alias for alias, _ in columns[:n_keys]]).agg(
        *[F.expr(expr).alias(alias) for alias, expr in columns[n_keys:]]
    )
