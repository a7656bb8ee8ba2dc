"""Continuous text outputs: collisions, coalescences, Lagrangian radii, stdout and namelists."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starfold import constants as K
from starfold.functions import stellar
from starfold.functions.numeric import div
from starfold.operators.dedup import forward_only, keep_all_but_last, keep_last
from starfold.operators.lagrangian import append_sigma, percent_column
from starfold.session import materialize

# Columns of coll.13.
COLL_13 = (
    "TIME[NB]",
    "NAME(I1)",
    "NAME(I2)",
    "K*(I1)",
    "K*(I2)",
    "K*(INEW)",
    "M(I1)[M*]",
    "M(I2)[M*]",
    "M(INEW)[M*]",
    "DM[M*]",
    "RS(I1)[R*]",
    "RS(I2)[R*]",
    "RI[RC]",
    "R12[R*]",
    "ECC",
    "P[days]",
)
# Columns of coal.24, long-standing layout.
COAL_24 = (
    "TIME[NB]",
    "NAME(I1)",
    "NAME(I2)",
    "K*(I1)",
    "K*(I2)",
    "K*(INEW)",
    "IQCOLL",
    "M(I1)[M*]",
    "M(I2)[M*]",
    "M(INEW)[M*]",
    "DM[M*]",
    "RS(I1)[R*]",
    "RS(I2)[R*]",
    "RI[RC]",
    "R12[R*]",
    "ECC",
    "P[days]",
    "RCOLL[R*]",
    "EB[NB]",
    "DP[NB]",
    "VINF[km/s]",
)
# Columns of coal.24, layout that starts with BINARY or ROCHE.
COAL_24_TAGGED = (
    "Coalescence_trigger",
    "IQCOLL",
    "TIME[NB]",
    "NAME(I1)",
    "NAME(I2)",
    "K*(I1)",
    "K*(I2)",
    "K*(INEW)",
    "COAL24_FIELD_08",
    "COAL24_FIELD_09",
    "COAL24_FIELD_10",
    "COAL24_FIELD_11",
    "COAL24_FIELD_12",
    "COAL24_FIELD_13",
    "COAL24_FIELD_14",
    "COAL24_FIELD_15",
    "M(I1)[M*]",
    "M(I2)[M*]",
    "M(INEW)[M*]",
    "DM[M*]",
    "COAL24_FIELD_20",
    "COAL24_FIELD_21",
    "COAL24_FIELD_22",
    "COAL24_FIELD_23",
    "ECC",
    "P[days]",
)
TRIGGERS = ("BINARY", "ROCHE")
# Metric prefixes of lagr.7 columns; the radii of single and binary stars have no
# core column.
LAGR7_METRICS = (
    "rlagr",
    "rlagr_s",
    "rlagr_b",
    "avmass",
    "nshell",
    "vx",
    "vy",
    "vz",
    "v",
    "vr",
    "vt",
    "sigma2",
    "sigma_r2",
    "sigma_t2",
    "vrot",
)
_SOURCE_ORDER = ["_file", "_split", "_row"]


def read_lines(spark: SparkSession, root: str, base: str) -> DataFrame:
    """All lines of the files below `root` whose name starts with `base`, with their order.

    (_file, _split) is one bounded piece of input, _row the order inside it.
    """
    lines = (
        spark.read.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{base}*")
        .load(root)
    )
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _number(token: Column) -> Column:
    return token.try_cast("double")


def _tokenised(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """Lines as token arrays `t`, next to their other columns.

    The one-element explode keeps Spark from copying the split into every later expression.
    """
    extra = [c for c in lines.columns if c != "value"]
    tokens = F.split(F.btrim("value", F.lit(" \t\r\n")), r"\s+")
    return lines.select(*extra, F.explode(F.array(tokens)).alias("t")), extra


def _named(rows: DataFrame, extra: list[str], names: tuple[str, ...]) -> DataFrame:
    return rows.select(
        *extra,
        *[
            (F.col("t")[i] if n == "Coalescence_trigger" else _number(F.col("t")[i])).alias(n)
            for i, n in enumerate(names)
        ],
    )


def parse_coll_13(lines: DataFrame) -> DataFrame:
    """Rows of exactly 16 tokens with a numeric first one; other tokens that fail become NULL."""
    rows, extra = _tokenised(lines)
    good = (F.size("t") == len(COLL_13)) & _number(F.try_element_at("t", F.lit(1))).isNotNull()
    return _named(rows.where(good), extra, COLL_13)


def parse_coal_24(lines: DataFrame) -> DataFrame:
    """21-token rows, or 26-token rows tagged BINARY / ROCHE; one pass, union of both columns."""
    rows, extra = _tokenised(lines)
    t = F.col("t")
    plain = (F.size(t) == len(COAL_24)) & _number(F.try_element_at(t, F.lit(1))).isNotNull()
    tagged = (
        (F.size(t) == len(COAL_24_TAGGED))
        & F.try_element_at(t, F.lit(1)).isin(*TRIGGERS)
        & _number(F.try_element_at(t, F.lit(3))).isNotNull()
    )
    names = [*COAL_24, *[n for n in COAL_24_TAGGED if n not in COAL_24]]

    def pick(name: str) -> Column:
        kind = (lambda c: c) if name == "Coalescence_trigger" else _number
        a = kind(t[COAL_24.index(name)]) if name in COAL_24 else F.lit(None)
        b = kind(t[COAL_24_TAGGED.index(name)]) if name in COAL_24_TAGGED else F.lit(None)
        return F.when(F.size(t) == len(COAL_24), a).otherwise(b)

    return rows.where(plain | tagged).select(*extra, *[pick(n).alias(n) for n in names])


def event_columns(events: DataFrame) -> DataFrame:
    """Primary / secondary masses and types of an event, and their type label."""
    m1, m2 = F.col("parent_mass_1_msun"), F.col("parent_mass_2_msun")
    k1, k2 = F.col("parent_kw_1"), F.col("parent_kw_2")
    return events.withColumns(
        {
            "primary_mass_msun": F.greatest(m1, m2),
            "secondary_mass_msun": F.least(m1, m2),
            "mass_ratio": div(F.least(m1, m2), F.greatest(m1, m2)),
            "primary_kw": F.greatest(k1, k2),
            "secondary_kw": F.least(k1, k2),
            "stellar_type": stellar.pair_type(k1, k2),
        }
    )


def normalised_events(raw: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """Engine names for the columns both event files share."""
    return raw.select(
        *keys,
        F.col("`TIME[NB]`").alias("ttot"),
        *[F.rint(f"`NAME(I{i})`").cast("bigint").alias(f"parent_name_{i}") for i in (1, 2)],
        *[F.rint(f"`K*(I{i})`").cast("int").alias(f"parent_kw_{i}") for i in (1, 2)],
        *[F.col(f"`M(I{i})[M*]`").alias(f"parent_mass_{i}_msun") for i in (1, 2)],
        F.col("ECC").alias("eccentricity"),
        F.lit(kind).alias("merger_type"),
    )


def merge_events(coll: DataFrame, coal: DataFrame, keys: list[str]) -> DataFrame:
    """Both event files as one table."""
    both = normalised_events(coll, "collision", keys).unionByName(
        normalised_events(coal, "coalescence", keys)
    )
    return event_columns(both)


def read_events(
    spark: SparkSession, root: str, simulation_id: str, tscale_myr: float
) -> DataFrame:
    """Cleaned collision and coalescence events of one simulation, `seq` by source order."""
    parts = []
    for base, parse in (("coll.13", parse_coll_13), ("coal.24", parse_coal_24)):
        rows = parse(read_lines(spark, root, base))
        # every split of a file is one chunk of the running maximum
        rows = rows.withColumn("_sim", F.lit(simulation_id))
        rows = forward_only(rows, ["_sim"], "TIME[NB]", "_row", chunk=["_file", "_split"])
        parts.append(rows.withColumn("simulation_id", F.col("_sim")))
    keys = ["simulation_id", *_SOURCE_ORDER]
    both = merge_events(parts[0], parts[1], keys)
    # Numbers that rise in source order; written, so that every reader sees the same ones.
    placed = both.withColumn("time_myr", F.col("ttot") * F.lit(float(tscale_myr))).repartitionByRange(
        *_SOURCE_ORDER
    )
    numbered = placed.sortWithinPartitions(*_SOURCE_ORDER).withColumn(
        "seq", F.monotonically_increasing_id()
    )
    return materialize(numbered.drop(*_SOURCE_ORDER), "ordered-events")


def lagr7_header() -> list[tuple[str, str]]:
    """(metric, suffix) of every lagr.7 column after the time column, in file order."""
    out = []
    for metric in LAGR7_METRICS:
        core = [] if metric in ("rlagr_s", "rlagr_b") else [K.LAGR_CORE]
        out += [(metric, s) for s in (*K.LAGR_FRACTIONS, *core)]
    return out


def parse_lagr_7(lines: DataFrame) -> DataFrame:
    """Time and the array of values of every numeric row.

    Rows with a non-numeric entry are dropped; a numeric row of another width is an error, since
    it means that the writing program changed its columns.
    """
    width = len(lagr7_header()) + 1
    rows, extra = _tokenised(lines)
    values = F.transform("t", lambda x: x.try_cast("double"))
    rows = rows.select(*extra, values.alias("v")).where(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())
    )
    message = F.concat(
        F.lit(f"lagr.7 row has not {width} columns but "), F.size("v").cast("string")
    )
    checked = F.when(F.size("v") == width, F.col("v")[0]).otherwise(
        F.raise_error(message).cast("double")
    )
    return rows.select(
        *extra, checked.alias("time_nb"), F.slice("v", 2, width - 1).alias("values")
    )


def clean_lagr_7(
    rows: DataFrame, keys: list[str], order: list[str], compat: bool = False
) -> DataFrame:
    """One row per time, the last written; `compat` keeps all occurrences but the last."""
    rule = keep_all_but_last if compat else keep_last
    return rule(rows, [*keys, "time_nb"], *order)


def lagr_7_long(rows: DataFrame, keys: list[str], scale: dict[str, float]) -> DataFrame:
    """Long form in physical units: time_myr, suffix, metric, value and percent, with sigmas.

    The value array is exploded next to a literal header array, so no 284-column frame arises.
    """
    factor = {
        **dict.fromkeys(("rlagr", "rlagr_s", "rlagr_b"), scale["r"]),
        "avmass": scale["m"],
        "nshell": 1.0,
        **dict.fromkeys(("vx", "vy", "vz", "v", "vr", "vt", "vrot"), scale["v"]),
        **dict.fromkeys(("sigma2", "sigma_r2", "sigma_t2"), scale["v"] ** 2),
    }
    header = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.lit(s).alias("suffix"),
                F.lit(float(factor[m])).alias("factor"),
            )
            for m, s in lagr7_header()
        ]
    )
    zipped = F.arrays_zip(header.alias("h"), F.col("values").alias("x"))
    long = rows.select(
        *keys,
        (F.col("time_nb") * F.lit(float(scale["t"]))).alias("time_myr"),
        F.explode(zipped).alias("z"),
    ).select(
        *keys,
        "time_myr",
        F.col("z.h.suffix").alias("suffix"),
        F.col("z.h.metric").alias("metric"),
        (F.col("z.x") * F.col("z.h.factor")).alias("value"),
    )
    return append_sigma(long.withColumn("percent", percent_column()))


def lagr_7_wide(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The file's own shape: one column per metric and suffix, N-body units."""
    names = [f"{m}{s}" for m, s in lagr7_header()]
    return rows.select(
        *keys, "time_nb", *[F.col("values")[i].alias(n) for i, n in enumerate(names)]
    )


def scale_factors(lines: DataFrame) -> dict[str, float]:
    """Unit factors r, v, m, t of the first 'PHYSICAL SCALING' line, of the first file in order."""
    order = [c for c in _SOURCE_ORDER if c in lines.columns]
    found = lines.where(F.col("value").contains("PHYSICAL SCALING"))
    hit = (found.orderBy(*order) if order else found).select("value").first()
    if hit is None:
        raise ValueError("no PHYSICAL SCALING line found")
    found = re.findall(r"(\S+)\s*=\s*(\S+)", hit["value"].rsplit(":", 1)[-1])
    factors = {name: float(number) for name, number in found}
    return {short: factors[long] for short, long in zip("rvmt", ("R*", "V*", "M*", "T*"))}


def namelist_value(spark: SparkSession, path: str, key: str) -> str:
    """Value of the first `key = value` of a namelist file, in any case."""
    pattern = rf"(?i)\s*{re.escape(key)}\s*=\s*([^,\s\n]+)"
    content = spark.read.text(path, wholetext=True)
    row = content.select(F.regexp_extract("value", pattern, 1).alias("v")).first()
    if row is None or not row["v"]:
        raise KeyError(f"key {key!r} not found in {path}")
    return row["v"].strip()


def read_table(lines: DataFrame, names: list[str]) -> DataFrame:
    """Whitespace-separated numeric table with the given columns; header lines fall out."""
    rows, extra = _tokenised(lines)
    good = (F.size("t") == len(names)) & _number(F.try_element_at("t", F.lit(1))).isNotNull()
    return _named(rows.where(good), extra, tuple(names))


def read_bdat(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """bdat / bwdat file: `skip` leading lines (1 for bwdat), a header line, numeric rows."""
    head = [r["value"] for r in spark.read.text(path).limit(skip + 1).collect()]
    return read_table(spark.read.text(path), head[skip].split())


def read_gwtc(spark: SparkSession, csv_path: str) -> DataFrame:
    """Gravitational-wave catalogue with the mass ratio and its asymmetric error bounds."""
    if not csv_path:
        raise FileNotFoundError("give the path of a catalogue CSV file")
    cat = spark.read.option("header", "true").csv(csv_path)
    masses = [
        f"mass_{i}_source{side}" for i in (1, 2) for side in ("", "_lower", "_upper")
    ]
    cat = cat.withColumns({c: F.col(c).try_cast("double") for c in masses})

    def bound(i: int, side: str) -> Column:
        return F.col(f"mass_{i}_source") + F.col(f"mass_{i}_source_{side}")

    ratio = div("mass_2_source", "mass_1_source")
    return cat.withColumns(
        {
            "mass_ratio": ratio,
            "mass_ratio_lower": div(bound(2, "lower"), bound(1, "upper")) - ratio,
            "mass_ratio_upper": div(bound(2, "upper"), bound(1, "lower")) - ratio,
        }
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of several sources, columns missing in one of them NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
