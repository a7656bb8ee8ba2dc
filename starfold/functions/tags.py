"""Boolean predicates and tags on stars and binaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starfold import constants as K
from starfold.functions.numeric import ColumnLike, col, div


def is_compact(kw: ColumnLike) -> Column:
    return col(kw).isin(*K.COMPACT_KW)


def compact_mask(df: DataFrame) -> Column:
    """Compact-object test for a singles frame (kw) or a binaries frame (kw_1 / kw_2)."""
    if "kw" in df.columns:
        return is_compact("kw")
    if {"kw_1", "kw_2"} <= set(df.columns):
        return is_compact("kw_1") | is_compact("kw_2")
    raise ValueError(f"no kw or kw_1/kw_2 column among {df.columns}")


def is_imbh(kw: ColumnLike, mass: ColumnLike) -> Column:
    """Black hole strictly between the IMBH mass bounds; FALSE when an operand is missing."""
    m = col(mass)
    test = (col(kw) == K.BH_KW) & (m > K.IMBH_MIN_MSUN) & (m < K.IMBH_MAX_MSUN) & ~F.isnan(m)
    return F.coalesce(test, F.lit(False))


def _bh_between(kw: ColumnLike, mass: ColumnLike, low: float, high: float) -> Column:
    return (col(kw) == K.BH_KW) & col(mass).between(low, high)


def is_b_type(kw: ColumnLike, teff: ColumnLike, mass: ColumnLike) -> Column:
    return (
        (col(kw) == 1)
        & col(teff).between(*K.B_TYPE_TEFF_K)
        & col(mass).between(*K.B_TYPE_MASS_MSUN)
    )


def _keep_true(df: DataFrame, tags: dict[str, Column], any_name: str) -> DataFrame:
    """Add the tags and their OR; a tag column that is already TRUE stays TRUE."""
    clean = {name: F.coalesce(test, F.lit(False)) for name, test in tags.items()}
    any_tag = F.lit(False)
    for test in clean.values():
        any_tag = any_tag | test
    clean[any_name] = any_tag
    return df.withColumns(
        {
            name: (F.col(name) | test) if name in df.columns else test
            for name, test in clean.items()
        }
    )


def tag_singles(df: DataFrame, *, r: str = "r_pc", speed: str = "speed_kms") -> DataFrame:
    """Tags of noteworthy single stars; the IMBH bounds are inclusive here."""
    return _keep_true(
        df,
        {
            "tag_imbh": _bh_between("kw", "mass_msun", K.IMBH_MIN_MSUN, K.IMBH_MAX_MSUN),
            "tag_ns": F.col("kw") == K.NS_KW,
            "tag_high_velocity_halo_star": (F.col(r) > K.HALO_STAR_R_PC)
            & (F.col(speed) > K.HALO_STAR_V_KMS),
        },
        "is_funny",
    )


def tag_binaries(df: DataFrame) -> DataFrame:
    """Tags of noteworthy binaries; the mass-transfer tags need cm_kw and are FALSE without it."""
    bh1, bh2 = F.col("kw_1") == K.BH_KW, F.col("kw_2") == K.BH_KW
    ns1, ns2 = F.col("kw_1") == K.NS_KW, F.col("kw_2") == K.NS_KW
    m1, m2 = F.col("mass_1_msun"), F.col("mass_2_msun")
    q = div(F.least(m1, m2), F.greatest(m1, m2))

    def bh_in(low: float, high: float) -> Column:
        return _bh_between("kw_1", m1, low, high) | _bh_between("kw_2", m2, low, high)

    if "cm_kw" in df.columns:
        odd = F.pmod(F.col("cm_kw"), F.lit(2)) == 1
        transferring, circular = (F.col("cm_kw") > 10) & odd, (F.col("cm_kw") >= 10) & ~odd
    else:
        transferring = circular = F.lit(False)
    return _keep_true(
        df,
        {
            "tag_imbh": bh_in(K.IMBH_MIN_MSUN, K.IMBH_MAX_MSUN),
            "tag_emr_bhbh": bh1 & bh2 & (q < K.EXTREME_MASS_RATIO_UPPER),
            "tag_high_e_bhbh": bh1 & bh2 & (F.col("eccentricity") > K.HIGH_BH_ECC_LOWER),
            "tag_pisne_mass_gap_bh": bh_in(*K.PISN_GAP_MSUN),
            "tag_bh_ns": (bh1 & ns2) | (bh2 & ns1),
            "tag_ns_any": ns1 | ns2,
            "tag_mass_transferring_binary": transferring,
            "tag_circularized_binary": circular,
        },
        "is_funny",
    )


def compact_categories(kw1: ColumnLike, kw2: ColumnLike) -> Column:
    """Array of the categories a pair belongs to; a pair may be in several."""
    a, b = col(kw1), col(kw2)
    has_bh = (a == K.BH_KW) | (b == K.BH_KW)
    has_ns = (a == K.NS_KW) | (b == K.NS_KW)
    both_heavy = a.isin(K.BH_KW, K.NS_KW) & b.isin(K.BH_KW, K.NS_KW)
    return F.array_compact(
        F.array(
            F.when(has_bh & both_heavy, "gw_source"),
            F.when(has_ns & ~has_bh, "pulsar"),
            F.when(is_compact(a) != is_compact(b), "xray_binary"),
        )
    )


def pair_key(id1: ColumnLike, id2: ColumnLike) -> Column:
    """'low-high' by numeric order."""
    a, b = col(id1).cast("bigint"), col(id2).cast("bigint")
    return F.concat_ws("-", F.least(a, b), F.greatest(a, b))


def pair_key_text(id1: ColumnLike, id2: ColumnLike) -> Column:
    """'low-high' by string order, as the IMBH tables print it."""
    a, b = col(id1).cast("string"), col(id2).cast("string")
    return F.concat_ws("-", F.least(a, b), F.greatest(a, b))


def escape_radius_pc(tidal_1: ColumnLike, rbar_pc: ColumnLike) -> tuple[Column, Column]:
    """(tidal radius, escape radius = twice that); NULL unless the tidal coefficient is positive."""
    t = col(tidal_1)
    tidal = F.when((t > 0) & ~F.isnan(t), F.pow(0.5 / t, F.lit(1.0 / 3.0)) * col(rbar_pc))
    return tidal, 2.0 * tidal
