"""SQL twins of the registered queries, run by DuckDB over the same tables.

Each text starts with the adapter views it needs as common table expressions. The SQL is written
straight from the operators' definitions (full windows, plain joins), not from the Spark plans.
"""

from __future__ import annotations

import math

from starfold import constants as K
from starfold.functions.display import C2_NM_K, WAVELENGTHS_NM, XYZ_TO_RGB, matching_curves
from starfold.sources.adapters import ADAPTERS, adapter_sql

ORACLES: dict[str, str] = {}
_NZERO = 100000
_TRH = 0.1 * 100000 / math.log(0.4 * 100000)
_TYPES = "map {" + ", ".join(f"{k}: '{v}'" for k, v in K.STELLAR_TYPES.items()) + "}"


def r(expr: str, digits: int = 6) -> str:
    """Rounded like `queries.tidy`: a relative 1e-13 nudge keeps decimal ties from differing."""
    return f"round(cast({expr} AS double) * cast(1.0000000000001 AS double), {digits}) + 0.0"


def big(expr: str) -> str:
    return f"cast({expr} AS bigint)"


def kw_name(expr: str) -> str:
    return f"({_TYPES})[{expr}]"


def pair_type(a: str, b: str) -> str:
    return f"{kw_name(f'greatest({a},{b})')} || '-' || {kw_name(f'least({a},{b})')}"


# Shared definitions, usable as further common table expressions.
STEPS = (
    "steps AS (SELECT *, simulation_id || '/' || run_dir || '/snap.40_' || "
    "cast(cast(filename_time AS int) AS varchar) || '.h5part' AS source_hdf5_path "
    "FROM snapshot_steps)"
)
STARS = "stars AS (SELECT *, sqrt(x_pc*x_pc+y_pc*y_pc+z_pc*z_pc) AS r_pc FROM snapshot_singles)"
PAIRS = (
    "pairs AS (SELECT *, sqrt(cm_x_pc*cm_x_pc+cm_y_pc*cm_y_pc+cm_z_pc*cm_z_pc) AS r_pc "
    "FROM snapshot_binaries)"
)
OBJECTS = (
    "objects AS (SELECT simulation_id, ttot, kw, mass_msun, r_pc FROM stars UNION ALL "
    "SELECT simulation_id, ttot, kw_1, mass_1_msun, r_pc FROM pairs UNION ALL "
    "SELECT simulation_id, ttot, kw_2, mass_2_msun, r_pc FROM pairs)"
)
ENERGETICS = f"""
raw_en AS (
  SELECT b.*, s.eclose_nb,
    (b.mass_1_msun/s.zmbar_msun)*(b.mass_2_msun/s.zmbar_msun)
      / nullif(2*(b.semi_major_axis_au/{K.PC_TO_AU!r}/s.rbar_pc), 0)
      / nullif(b.mass_1_msun/s.zmbar_msun + b.mass_2_msun/s.zmbar_msun, 0) AS ebind_nb,
    CASE WHEN s.nc > 0 AND s.rc_nb > 0 THEN
      cbrt(4*pi()*s.rc_nb*s.rc_nb*s.rc_nb/(3*s.nc)) * s.rbar_pc * {K.PC_TO_AU!r} END
      AS mean_core_distance_au
  FROM snapshot_binaries b LEFT JOIN snapshot_scalars s USING (simulation_id, ttot)),
en AS (
  SELECT *, ebind_nb / nullif(0.001*eclose_nb, 0) AS ebind_over_kt,
    CASE WHEN bin_label = 1 THEN 'hard'
         WHEN eclose_nb > 0 AND semi_major_axis_au > mean_core_distance_au
              AND ebind_nb < 0.001*eclose_nb THEN 'temporary'
         ELSE 'soft' END AS binary_class
  FROM raw_en)"""
_E2 = "(eccentricity*eccentricity)"
_M12 = "(mass_1_msun*mass_2_msun*(mass_1_msun+mass_2_msun))"
TAU = (
    f"CASE WHEN {_M12} <> 0 THEN least({K.TAU_GW_MYR!r} * pow(semi_major_axis_au, 4) * "
    f"pow(1-{_E2}, 3.5) / ({_M12} * (1 + 73.0*{_E2}/24 + 37.0*{_E2}*{_E2}/96)), 13800.0) END"
)


def oracle(name: str, views: str, body: str, *ctes: str) -> None:
    """Register `body` behind the adapter views (space separated) and further CTEs."""
    full = {v.replace("snapshot_", ""): v for v in ADAPTERS}
    parts = [f"{full[v]} AS ({adapter_sql(full[v])})" for v in views.split()]
    recursive = "RECURSIVE " if any("USING KEY" in c for c in ctes) else ""
    ORACLES[name] = f"WITH {recursive}{', '.join([*parts, *ctes])} {body.strip()}"


oracle(
    "snapshot_summary",
    "singles binaries scalars",
    f"""
SELECT s.simulation_id, {r('s.ttot')} AS ttot, {r('s.ttot*s.tscale_myr')} AS time_myr,
  {big('s.n_single')} AS n_singles, {big('s.n_binary')} AS n_binaries,
  {big('coalesce(p.n_bh,0)')} AS n_bh, {big('coalesce(p.n_ns,0)')} AS n_ns,
  {big('coalesce(p.n_wd,0)')} AS n_wd, {r('coalesce(p.total,0)')} AS total_mass_msun,
  {r('s.rc_nb*s.rbar_pc')} AS core_radius_pc, {r('coalesce(h.r,0)')} AS half_mass_radius_pc,
  {r('s.rg_x_pc')} AS rg_x_pc, {r('s.rg_y_pc')} AS rg_y_pc, {r('s.rg_z_pc')} AS rg_z_pc,
  {r('s.vg_x_kmps')} AS vg_x_kmps, {r('s.vg_y_kmps')} AS vg_y_kmps, {r('s.vg_z_kmps')} AS vg_z_kmps
FROM snapshot_scalars s LEFT JOIN pop p USING (simulation_id, ttot)
  LEFT JOIN half h USING (simulation_id, ttot)""",
    STARS,
    PAIRS,
    OBJECTS,
    "pop AS (SELECT simulation_id, ttot, count(*) FILTER (kw=14) AS n_bh, "
    "count(*) FILTER (kw=13) AS n_ns, count(*) FILTER (kw IN (10,11,12)) AS n_wd, "
    "sum(mass_msun) AS total FROM objects GROUP BY ALL)",
    "cum AS (SELECT simulation_id, ttot, r_pc, sum(mass_msun) OVER (PARTITION BY simulation_id, "
    "ttot ORDER BY r_pc, kw, mass_msun ROWS UNBOUNDED PRECEDING) AS c, sum(mass_msun) OVER "
    "(PARTITION BY simulation_id, ttot) AS t FROM objects)",
    "half AS (SELECT simulation_id, ttot, min(r_pc) AS r FROM cum WHERE c >= 0.5*t AND t > 0 "
    "GROUP BY ALL)",
)


def _compact_side(i: int) -> str:
    o = 3 - i
    return f"""
SELECT simulation_id, ttot, object_id_{i} AS object_id, kw_{i} AS kw, mass_{i}_msun AS mass_msun,
  cm_x_pc AS x_pc, cm_y_pc AS y_pc, cm_z_pc AS z_pc, cm_vx_kms AS vx_kms, cm_vy_kms AS vy_kms,
  cm_vz_kms AS vz_kms, r_pc, true AS is_in_binary, object_id_{o} AS companion_id,
  kw_{o} AS companion_kw, cm_id AS binary_cm_id, mass_{o}_msun AS companion_mass_msun,
  semi_major_axis_au, eccentricity FROM pairs WHERE kw_{i} BETWEEN 10 AND 14"""


oracle(
    "compact_object_history",
    "singles binaries scalars",
    f"""
SELECT c.simulation_id, {r('c.ttot')} AS ttot, {r('c.ttot*s.tscale_myr')} AS time_myr,
  {big('object_id')} AS object_id, {big('kw')} AS kw,
  CASE kw WHEN 14 THEN 'BH' WHEN 13 THEN 'NS' ELSE 'WD' END AS object_type,
  {r('mass_msun')} AS mass_msun, {r('x_pc')} AS x_pc, {r('y_pc')} AS y_pc, {r('z_pc')} AS z_pc,
  {r('vx_kms')} AS vx_kms, {r('vy_kms')} AS vy_kms, {r('vz_kms')} AS vz_kms, {r('r_pc')} AS r_pc,
  is_in_binary, {big('companion_id')} AS companion_id, {big('companion_kw')} AS companion_kw,
  {big('binary_cm_id')} AS binary_cm_id, {r('companion_mass_msun')} AS companion_mass_msun,
  {r('semi_major_axis_au')} AS semi_major_axis_au, {r('eccentricity')} AS eccentricity,
  'lake/' || c.simulation_id AS source_hdf5_path
FROM c LEFT JOIN snapshot_scalars s USING (simulation_id, ttot)""",
    STARS,
    PAIRS,
    "c AS (SELECT simulation_id, ttot, object_id, kw, mass_msun, x_pc, y_pc, z_pc, vx_kms, vy_kms, "
    "vz_kms, r_pc, false AS is_in_binary, cast(NULL AS bigint) AS companion_id, cast(NULL AS int) "
    "AS companion_kw, cast(NULL AS bigint) AS binary_cm_id, cast(NULL AS double) AS "
    "companion_mass_msun, cast(NULL AS double) AS semi_major_axis_au, cast(NULL AS double) AS "
    "eccentricity FROM stars WHERE kw BETWEEN 10 AND 14 UNION ALL "
    f"{_compact_side(1)} UNION ALL {_compact_side(2)})",
)
_PAIR_ID = f"simulation_id, {r('ttot')} AS ttot, object_id_1, object_id_2"
oracle(
    "binary_energetics_class",
    "binaries scalars",
    f"""
SELECT {_PAIR_ID}, {r('ebind_nb')} AS ebind_nb, {r('mean_core_distance_au', 3)} AS
  mean_core_distance_au, {r('ebind_over_kt', 3)} AS ebind_over_kt, binary_class,
  {r('greatest(mass_1_msun, mass_2_msun)')} AS primary_mass_msun,
  {r('least(mass_1_msun, mass_2_msun)')} AS secondary_mass_msun,
  {r('mass_1_msun+mass_2_msun')} AS total_mass_msun,
  {r('least(mass_1_msun,mass_2_msun)/greatest(mass_1_msun,mass_2_msun)')} AS mass_ratio,
  {big('greatest(kw_1,kw_2)')} AS primary_kw, {big('least(kw_1,kw_2)')} AS secondary_kw,
  {pair_type('kw_1', 'kw_2')} AS stellar_type,
  {r('semi_major_axis_au*(1-eccentricity)')} AS peri_au,
  {r(f'(radius_1_rsun+radius_2_rsun)*{K.SOLRAD_TO_AU!r}')} AS sum_of_radius_au,
  {r(TAU)} AS tau_gw_myr
FROM en""",
    ENERGETICS,
)
oracle(
    "drop_temporary",
    "binaries scalars",
    f"SELECT {_PAIR_ID}, binary_class FROM en WHERE binary_class IS DISTINCT FROM 'temporary'",
    ENERGETICS,
)
oracle(
    "class_counts",
    "binaries scalars",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, binary_class, n,
  {r('n / sum(n) OVER (PARTITION BY simulation_id, ttot)')} AS frac
FROM (SELECT simulation_id, ttot, binary_class, count(*) AS n FROM en GROUP BY ALL)""",
    ENERGETICS,
)
oracle(
    "kstar_states",
    "binaries",
    f"""
SELECT {_PAIR_ID}, {big('cm_kw')} AS cm_kw, cm_kw = 0 AS is_standard,
  cm_kw >= 10 AND cm_kw % 2 = 1 AS mt_ongoing, cm_kw > 10 AND cm_kw % 2 = 0 AS mt_past,
  {big('CASE WHEN cm_kw >= 10 THEN (cm_kw - CASE WHEN cm_kw % 2 = 1 THEN 9 ELSE 10 END) // 2 '
       'ELSE 0 END')} AS mt_phase_index,
  cm_kw = -25 AS is_relativistic_binary, cm_kw = -1 AS is_chaotic_tide_binary,
  {big('CASE WHEN kw_1 > 100 THEN kw_1 - 100 ELSE kw_1 END')} AS base_kw_1,
  {big('CASE WHEN kw_2 > 100 THEN kw_2 - 100 ELSE kw_2 END')} AS base_kw_2,
  kw_1 > 100 AS in_ce_1, kw_2 > 100 AS in_ce_2
FROM snapshot_binaries""",
)
_DERIVED_LABEL = f"""CASE WHEN cm_id < 0 THEN -1
  WHEN pert_gamma = cast(0 AS float) AND cm_kw = -1 THEN 0
  WHEN cm_id > {_NZERO} AND cm_id - {_NZERO} IN (object_id_1, object_id_2) THEN 1
  WHEN pert_gamma = cast(0.1 AS float) THEN -1 ELSE -9 END"""
oracle(
    "bin_label_backfill",
    "binaries",
    f"SELECT {_PAIR_ID}, {big(f'CASE WHEN bin_label = -9 THEN {_DERIVED_LABEL} ELSE bin_label END')}"
    " AS bin_label FROM snapshot_binaries",
)
oracle(
    "backfill_report",
    "binaries",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, count(*) AS unknown_before,
  count(*) FILTER (n = 1) AS to_hard, count(*) FILTER (n = 0) AS to_wide,
  count(*) FILTER (n = -1) AS to_merger_or_hierarchical, count(*) FILTER (n = -9) AS still_unknown
FROM (SELECT simulation_id, ttot, {_DERIVED_LABEL} AS n FROM snapshot_binaries
      WHERE bin_label = -9) GROUP BY simulation_id, ttot""",
)
oracle(
    "backfill_confusion",
    "binaries",
    f"""
SELECT {big('bin_label')} AS true_label, {big(_DERIVED_LABEL)} AS predicted_label, count(*) AS n
FROM snapshot_binaries WHERE bin_label <> -9 GROUP BY 1, 2""",
)
HITS = f"""
base AS (SELECT b.simulation_id, b.ttot, least(object_id_1, object_id_2) AS bin_name1,
    greatest(object_id_1, object_id_2) AS bin_name2, kw_1, kw_2,
    b.ttot*s.tscale_myr AS time_myr,
    {kw_name('kw_1')} || '-' || {kw_name('kw_2')} AS stellar_type
  FROM snapshot_binaries b LEFT JOIN snapshot_scalars s USING (simulation_id, ttot)),
hits AS (
  SELECT *, 'gw_source' AS category FROM base
    WHERE kw_1 IN (13,14) AND kw_2 IN (13,14) AND (kw_1 = 14 OR kw_2 = 14)
  UNION ALL SELECT *, 'pulsar' FROM base
    WHERE (kw_1 = 13 OR kw_2 = 13) AND kw_1 <> 14 AND kw_2 <> 14
  UNION ALL SELECT *, 'xray_binary' FROM base
    WHERE (kw_1 BETWEEN 10 AND 14) <> (kw_2 BETWEEN 10 AND 14)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY simulation_id, category, bin_name1, bin_name2
    ORDER BY ttot, kw_1, kw_2) AS up, count(*) OVER (PARTITION BY simulation_id, category,
    bin_name1, bin_name2) AS n FROM hits),
compact_pairs AS (
  SELECT a.simulation_id, a.category, a.bin_name1, a.bin_name2, a.ttot AS first_ttot,
    z.ttot AS last_ttot, a.time_myr AS first_time_myr, z.time_myr AS last_time_myr,
    a.kw_1 AS first_kw1, a.kw_2 AS first_kw2, z.kw_1 AS last_kw1, z.kw_2 AS last_kw2,
    a.stellar_type AS first_stellar_type, z.stellar_type AS last_stellar_type, a.n
  FROM ranked a JOIN ranked z USING (simulation_id, category, bin_name1, bin_name2)
  WHERE a.up = 1 AND z.up = z.n)"""
oracle(
    "compact_binary_summary",
    "binaries scalars",
    f"""
SELECT simulation_id, category, bin_name1, bin_name2, {r('first_ttot')} AS first_ttot,
  {r('last_ttot')} AS last_ttot, {r('first_time_myr')} AS first_time_myr,
  {r('last_time_myr')} AS last_time_myr, {big('first_kw1')} AS first_kw1,
  {big('first_kw2')} AS first_kw2, {big('last_kw1')} AS last_kw1, {big('last_kw2')} AS last_kw2,
  first_stellar_type, last_stellar_type, n AS n_snapshots_seen_in_category
FROM compact_pairs""",
    HITS,
)
oracle(
    "compact_binary_totals",
    "binaries scalars",
    f"""
SELECT simulation_id, count(*) AS scanned_snapshots, {r('max(ttot)')} AS max_ttot,
  {r('max(ttot*tscale_myr)')} AS max_time_myr,
  (SELECT count(*) FROM compact_pairs p WHERE p.simulation_id = s.simulation_id
    AND category = 'gw_source') AS gw_source,
  (SELECT count(*) FROM compact_pairs p WHERE p.simulation_id = s.simulation_id
    AND category = 'pulsar') AS pulsar,
  (SELECT count(*) FROM compact_pairs p WHERE p.simulation_id = s.simulation_id
    AND category = 'xray_binary') AS xray_binary
FROM snapshot_scalars s GROUP BY simulation_id""",
    HITS,
)
oracle(
    "binaries_by_type",
    "binaries",
    f"SELECT {_PAIR_ID}, {big('kw_1')} AS kw_1, {big('kw_2')} AS kw_2 FROM snapshot_binaries "
    "WHERE kw_1 = 14 OR kw_2 = 14",
)
_KEY = "least(object_id_1,object_id_2) || '-' || greatest(object_id_1,object_id_2)"
oracle(
    "primordial_binaries",
    "binaries",
    f"""
SELECT {_PAIR_ID}, least(object_id_1,object_id_2) AS primordial_name_min,
  greatest(object_id_1,object_id_2) AS primordial_name_max, {_KEY} AS primordial_pair_key,
  true AS is_primordial_binary
FROM snapshot_binaries WHERE ttot = 0 AND abs(object_id_1-object_id_2) = 1""",
)
_B1, _B2 = (
    f"(kw_{i} = 1 AND teff_{i}_k BETWEEN 10500 AND 31500 AND mass_{i}_msun BETWEEN 2.75 AND 17.7)"
    for i in (1, 2)
)
oracle(
    "b_type_binaries",
    "binaries",
    f"""
SELECT {_PAIR_ID}, {_KEY} AS b_type_pair_key, {_B1} AS b_type_member1, {_B2} AS b_type_member2,
  {big(f'cast({_B1} AS int) + cast({_B2} AS int)')} AS b_type_member_count,
  EXISTS (SELECT 1 FROM snapshot_binaries p WHERE p.ttot = 0
    AND abs(p.object_id_1-p.object_id_2) = 1 AND p.simulation_id = b.simulation_id
    AND p.object_id_1 = b.object_id_1 AND p.object_id_2 = b.object_id_2) AS is_primordial_binary
FROM snapshot_binaries b WHERE {_B1} OR {_B2}""",
)
_SPEED = "sqrt(vx_kms*vx_kms+vy_kms*vy_kms+vz_kms*vz_kms)"
oracle(
    "funny_singles",
    "singles",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id, i AS tag_imbh, n AS tag_ns,
  h AS tag_high_velocity_halo_star, i OR n OR h AS is_funny
FROM (SELECT *, kw = 14 AND mass_msun BETWEEN 100 AND 100000 AS i, kw = 13 AS n,
        r_pc > 20 AND {_SPEED} > 50 AS h FROM stars)""",
    STARS,
)
oracle(
    "funny_binaries",
    "binaries",
    f"""
SELECT {_PAIR_ID}, a AS tag_imbh, b AS tag_emr_bhbh, c AS tag_high_e_bhbh,
  d AS tag_pisne_mass_gap_bh, e AS tag_bh_ns, f AS tag_ns_any, g AS tag_mass_transferring_binary,
  h AS tag_circularized_binary, a OR b OR c OR d OR e OR f OR g OR h AS is_funny
FROM (SELECT *,
  (kw_1 = 14 AND mass_1_msun BETWEEN 100 AND 100000) OR
    (kw_2 = 14 AND mass_2_msun BETWEEN 100 AND 100000) AS a,
  kw_1 = 14 AND kw_2 = 14 AND
    least(mass_1_msun,mass_2_msun)/greatest(mass_1_msun,mass_2_msun) < 0.1 AS b,
  kw_1 = 14 AND kw_2 = 14 AND eccentricity > 0.1 AS c,
  (kw_1 = 14 AND mass_1_msun BETWEEN 64 AND 161) OR
    (kw_2 = 14 AND mass_2_msun BETWEEN 64 AND 161) AS d,
  (kw_1 = 14 AND kw_2 = 13) OR (kw_1 = 13 AND kw_2 = 14) AS e,
  kw_1 = 13 OR kw_2 = 13 AS f, cm_kw > 10 AND cm_kw % 2 = 1 AS g,
  cm_kw >= 10 AND cm_kw % 2 = 0 AS h FROM snapshot_binaries)""",
)
oracle(
    "derived_singles",
    "singles scalars",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id, {r('ttot*tscale_myr')} AS time_myr,
  {r('ttot_over_tcr0')} AS ttot_over_tcr0, {r(f'ttot_over_tcr0/{_TRH!r}')} AS ttot_over_trh0,
  {r('r_pc')} AS r_pc, {r(_SPEED)} AS speed_kms,
  lpad(cast(kw AS varchar), 2, ' ') || ':' || {kw_name('kw')} AS stellar_type,
  {r('CASE WHEN kw IN (13,14) THEN 0.000009*1.2 ELSE luminosity_lsun END')} AS luminosity_display,
  {r('CASE WHEN kw IN (13,14) THEN greatest(least(teff_k,1050000),1000) ELSE teff_k END')}
    AS teff_display
FROM stars LEFT JOIN snapshot_scalars USING (simulation_id, ttot)""",
    STARS,
)
oracle(
    "density_centred",
    "singles scalars",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id,
  {r('x_pc - rdens_x_nb*rbar_pc')} AS x_c_pc, {r('y_pc - rdens_y_nb*rbar_pc')} AS y_c_pc,
  {r('z_pc - rdens_z_nb*rbar_pc')} AS z_c_pc
FROM snapshot_singles LEFT JOIN snapshot_scalars USING (simulation_id, ttot)""",
)
oracle(
    "cluster_cm_velocity",
    "singles",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, {r('x')} AS vcm_x_kms, {r('y')} AS vcm_y_kms,
  {r('z')} AS vcm_z_kms, {r('sqrt(x*x+y*y+z*z)')} AS vcm_kms, sqrt(x*x+y*y+z*z) > 1 AS is_high
FROM (SELECT simulation_id, ttot, sum(vx_kms*mass_msun)/sum(mass_msun) AS x,
  sum(vy_kms*mass_msun)/sum(mass_msun) AS y, sum(vz_kms*mass_msun)/sum(mass_msun) AS z
  FROM snapshot_singles GROUP BY simulation_id, ttot)""",
)
oracle(
    "snapshot_validity",
    "singles binaries scalars",
    f"""
SELECT s.simulation_id, {r('s.ttot')} AS ttot, cast(1 AS bigint) AS n_scalar_rows, {big('n_single')} AS n_single,
  {big('n_binary')} AS n_binary, coalesce(a.n, 0) AS rows_single, coalesce(b.n, 0) AS rows_binary,
  true AS is_valid, coalesce(a.n, 0) = n_single AND coalesce(b.n, 0) = n_binary AS counts_match
FROM snapshot_scalars s
LEFT JOIN (SELECT simulation_id, ttot, count(*) AS n FROM snapshot_singles GROUP BY ALL) a
  USING (simulation_id, ttot)
LEFT JOIN (SELECT simulation_id, ttot, count(*) AS n FROM snapshot_binaries GROUP BY ALL) b
  USING (simulation_id, ttot)""",
)

_FRACTIONS = ", ".join(f"('{s}', cast({float(s)!r} AS double))" for s in K.LAGR_FRACTIONS)
_LABELS = ", ".join(
    f"('{s}', '{K.percent_label(s)}')" for s in (*K.LAGR_FRACTIONS, K.LAGR_CORE)
)
_RUN = (
    "OVER (PARTITION BY simulation_id, ttot ORDER BY r_pc, object_id ROWS UNBOUNDED PRECEDING)"
)
PROFILE = f"""
mean_v AS (SELECT simulation_id, ttot, sum(mass_msun*vx_kms)/sum(mass_msun) AS cx,
    sum(mass_msun*vy_kms)/sum(mass_msun) AS cy, sum(mass_msun*vz_kms)/sum(mass_msun) AS cz,
    sum(mass_msun) AS total FROM stars GROUP BY ALL),
moved AS (SELECT simulation_id, ttot, object_id, r_pc, mass_msun AS m, total,
    vx_kms-cx AS ux, vy_kms-cy AS uy, vz_kms-cz AS uz, x_pc AS px, y_pc AS py, z_pc AS pz
  FROM stars JOIN mean_v USING (simulation_id, ttot)),
speeds AS (SELECT *, ux*ux+uy*uy+uz*uz AS u2,
    coalesce((ux*px+uy*py+uz*pz)/nullif(r_pc,0), 0) AS ur,
    coalesce(sqrt(pow(py*uz-pz*uy,2)+pow(pz*ux-px*uz,2)+pow(px*uy-py*ux,2))/nullif(r_pc,0), 0)
      AS urot FROM moved),
prefix AS (SELECT simulation_id, ttot, r_pc, object_id, total, sum(m) {_RUN} AS m,
    count(*) {_RUN} AS n, sum(m*ux) {_RUN} AS sx, sum(m*uy) {_RUN} AS sy, sum(m*uz) {_RUN} AS sz,
    sum(m*sqrt(u2)) {_RUN} AS sv, sum(m*ur) {_RUN} AS sr,
    sum(m*sqrt(greatest(u2-ur*ur,0))) {_RUN} AS st, sum(m*u2) {_RUN} AS sv2,
    sum(m*ur*ur) {_RUN} AS sr2, sum(m*urot) {_RUN} AS srot FROM speeds),
picked AS (
  SELECT f.suffix, p.* FROM (VALUES {_FRACTIONS}) f(suffix, frac), prefix p
    WHERE p.m >= p.total*f.frac
    QUALIFY row_number() OVER (PARTITION BY simulation_id, ttot, suffix ORDER BY n) = 1
  UNION ALL
  SELECT '<RC', p.* FROM prefix p JOIN snapshot_scalars s USING (simulation_id, ttot)
    WHERE p.r_pc <= s.rc_nb*s.rbar_pc
    QUALIFY row_number() OVER (PARTITION BY simulation_id, ttot ORDER BY p.n DESC) = 1
  UNION ALL
  SELECT '<RC', s.simulation_id, s.ttot, NULL, NULL, NULL, NULL, 0, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, NULL, NULL FROM snapshot_scalars s
    WHERE EXISTS (SELECT 1 FROM prefix p WHERE p.simulation_id = s.simulation_id
      AND p.ttot = s.ttot) AND NOT EXISTS (SELECT 1 FROM prefix p WHERE
      p.simulation_id = s.simulation_id AND p.ttot = s.ttot AND p.r_pc <= s.rc_nb*s.rbar_pc)),
means AS (SELECT *, sx/m AS vx, sy/m AS vy, sz/m AS vz, sr/m AS vr, sv2/m AS v2, sr2/m AS r2
  FROM picked),
spread AS (SELECT *, CASE WHEN n > 0 THEN greatest(v2-(vx*vx+vy*vy+vz*vz),0) END AS sigma2,
    CASE WHEN n > 0 THEN greatest(r2-vr*vr,0) END AS sigma_r2 FROM means),
profile AS (SELECT simulation_id, ttot, suffix, r_pc AS rlagr, m/nullif(n,0) AS avmass,
    n AS nshell, vx, vy, vz, sv/m AS v, vr, st/m AS vt, sigma2, sigma_r2,
    CASE WHEN n > 0 THEN greatest(sigma2-sigma_r2,0) END AS sigma_t2, srot/m AS vrot FROM spread)"""
_ROUNDED = ", ".join(f"{r(m)} AS {m}" for m in K.LAGR_METRICS if m != "nshell")
oracle(
    "lagrangian_profile",
    "singles scalars",
    f"SELECT simulation_id, {r('ttot')} AS ttot, suffix, {big('nshell')} AS nshell, {_ROUNDED} "
    "FROM profile",
    STARS,
    PROFILE,
)
_TALL = " UNION ALL ".join(
    f"SELECT simulation_id, ttot, suffix, '{m}' AS metric, cast({m} AS double) AS value "
    "FROM profile"
    for m in K.LAGR_METRICS
)
LONG = (
    f"tall AS ({_TALL}), both_rows AS (SELECT * FROM tall UNION ALL SELECT simulation_id, ttot, "
    "suffix, left(metric, length(metric)-1), sqrt(value) FROM tall WHERE metric IN "
    "('sigma2','sigma_r2','sigma_t2'))"
)
oracle(
    "lagrangian_long",
    "singles scalars",
    f"SELECT simulation_id, {r('ttot')} AS ttot, suffix, l.percent, metric, {r('value')} AS value "
    f"FROM both_rows JOIN (VALUES {_LABELS}) l(suffix, percent) USING (suffix)",
    STARS,
    PROFILE,
    LONG,
)
oracle(
    "initial_total_mass",
    "singles",
    f"SELECT simulation_id, {r('sum(mass_msun)')} AS initial_total_mass_msun "
    "FROM snapshot_singles WHERE ttot = 0 GROUP BY simulation_id",
)

HISTORY = """
roles AS (SELECT *, object_id_1 AS object_id, object_id_2 AS companion_id, 1 AS member
    FROM snapshot_binaries UNION ALL SELECT *, object_id_2, object_id_1, 2 FROM snapshot_binaries),
first_role AS (SELECT * FROM roles QUALIFY row_number() OVER (PARTITION BY simulation_id, object_id,
    ttot ORDER BY member, object_id_1, object_id_2) = 1),
history AS (SELECT simulation_id, object_id, ttot, s.kw, s.mass_msun, b.companion_id, b.member,
    b.cm_id, b.semi_major_axis_au,
    CASE WHEN b.companion_id IS NOT NULL THEN 'binary' ELSE 'single' END AS state
  FROM snapshot_singles s FULL JOIN first_role b USING (simulation_id, object_id, ttot))"""
oracle(
    "particle_history",
    "singles binaries",
    f"""
SELECT simulation_id, object_id, {r('ttot')} AS ttot, {big('kw')} AS kw, {r('mass_msun')} AS
  mass_msun, companion_id, {big('member')} AS member, cm_id, {r('semi_major_axis_au')} AS
  semi_major_axis_au, state, CASE WHEN state = 'binary' THEN 'binary'
  WHEN NOT bool_or(state = 'binary') OVER (PARTITION BY simulation_id, object_id) THEN 'single'
  END AS state_raw
FROM history""",
    HISTORY,
)
oracle(
    "stored_histories",
    "singles binaries",
    f"""
SELECT simulation_id, object_id, count(*) AS n, count(*) FILTER (state = 'binary') AS n_binary,
  {r('min(ttot)')} AS first_ttot, {r('max(ttot)')} AS last_ttot, {r('sum(mass_msun)')} AS mass_msun
FROM history GROUP BY simulation_id, object_id""",
    HISTORY,
)
oracle(
    "particle_summary",
    "singles binaries",
    f"""
SELECT h.simulation_id, h.object_id, count(*) AS total_snapshots, {r('min(ttot)')} AS first_ttot,
  {r('max(ttot)')} AS last_ttot, count(*) FILTER (state = 'single') AS single_count,
  count(*) FILTER (state = 'binary') AS binary_count,
  {r('first(mass_msun ORDER BY ttot) FILTER (mass_msun IS NOT NULL)')} AS initial_mass_msun,
  {r('last(mass_msun ORDER BY ttot) FILTER (mass_msun IS NOT NULL)')} AS final_mass_msun,
  coalesce((SELECT string_agg(cast(k.kw AS varchar), ',' ORDER BY k.t, k.kw) FROM kinds k
    WHERE k.simulation_id = h.simulation_id AND k.object_id = h.object_id), '') AS stellar_types
FROM history h GROUP BY h.simulation_id, h.object_id""",
    HISTORY,
    "kinds AS (SELECT simulation_id, object_id, kw, min(ttot) AS t FROM history "
    "WHERE kw IS NOT NULL GROUP BY ALL)",
)
oracle(
    "history_sampled",
    "singles binaries",
    f"""
SELECT DISTINCT simulation_id, object_id, {r('t')} AS ttot, state FROM (
  SELECT g.simulation_id, g.object_id, arg_min(h.ttot, h.ttot) AS t, arg_min(h.state, h.ttot) AS state
  FROM (SELECT simulation_id, object_id, lo + 10.0*unnest(range(cast((hi-lo)/10 AS int) + 2)) AS t
        FROM (SELECT simulation_id, object_id, min(ttot) AS lo, max(ttot) AS hi FROM history
              GROUP BY ALL)) g
  JOIN history h ON h.simulation_id = g.simulation_id AND h.object_id = g.object_id
    AND h.ttot >= g.t
  GROUP BY g.simulation_id, g.object_id, g.t)""",
    HISTORY,
)
oracle(
    "history_nearest",
    "singles binaries",
    f"SELECT simulation_id, object_id, {r('ttot')} AS ttot, state FROM history QUALIFY row_number() "
    "OVER (PARTITION BY simulation_id, object_id ORDER BY abs(ttot-40.5), ttot) = 1",
    HISTORY,
)
oracle(
    "history_early_stop",
    "singles binaries scalars",
    f"""
SELECT simulation_id, object_id, {r('ttot')} AS ttot FROM (
  SELECT *, max(gap >= 5) OVER (PARTITION BY simulation_id, object_id ORDER BY file_index, ttot
    ROWS UNBOUNDED PRECEDING) AS stopped FROM (
    SELECT *, file_index - lag(file_index, 1, 0) OVER (PARTITION BY simulation_id, object_id
      ORDER BY file_index, ttot) - 1 AS gap
    FROM history JOIN (SELECT simulation_id, ttot, cast(floor(ttot/4) AS int)+1 AS file_index
      FROM snapshot_scalars) USING (simulation_id, ttot)))
WHERE NOT stopped""",
    HISTORY,
)
oracle(
    "evolution_path",
    "singles binaries",
    f"""
SELECT simulation_id, object_id, count(*) AS n_epochs, {r('min(ttot)')} AS first_epoch,
  {r('max(ttot)')} AS last_epoch, arg_max(state, ttot) AS last_state
FROM (SELECT *, lag(kw) OVER w AS k0, lag(companion_id) OVER w AS c0, lag(state) OVER w AS s0
      FROM history WINDOW w AS (PARTITION BY simulation_id, object_id ORDER BY ttot))
WHERE s0 IS NULL OR kw IS DISTINCT FROM k0 OR companion_id IS DISTINCT FROM c0 OR state <> s0
GROUP BY simulation_id, object_id""",
    HISTORY,
)
CANDIDATES = f"""
candidates AS (
  SELECT b.simulation_id, b.ttot, b.cm_id, b.object_id_1, b.object_id_2, s.object_id AS third_id,
    sqrt(pow(s.x_pc-b.cm_x_pc,2)+pow(s.y_pc-b.cm_y_pc,2)+pow(s.z_pc-b.cm_z_pc,2)) AS distance_pc,
    pow(s.vx_kms-b.cm_vx_kms,2)+pow(s.vy_kms-b.cm_vy_kms,2)+pow(s.vz_kms-b.cm_vz_kms,2) AS v2,
    b.mass_1_msun+b.mass_2_msun AS m_bin, s.mass_msun AS m3, b.semi_major_axis_au, b.eccentricity,
    b.kw_1, b.kw_2, s.kw AS third_kw
  FROM snapshot_binaries b JOIN snapshot_singles s USING (simulation_id, ttot)
  WHERE s.object_id NOT IN (b.object_id_1, b.object_id_2) AND distance_pc
    <= b.semi_major_axis_au/{K.PC_TO_AU!r}*1000)"""
oracle(
    "triple_systems",
    "singles binaries",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, cm_id, object_id_1, object_id_2, third_id,
  {r('distance_pc')} AS distance_pc, {r('e')} AS e_bind, {r('m_bin')} AS binary_mass_msun,
  {r('m3')} AS third_mass_msun, {r('semi_major_axis_au')} AS semi_major_axis_au,
  {r('eccentricity')} AS eccentricity, {big('kw_1')} AS kw_1, {big('kw_2')} AS kw_2,
  {big('third_kw')} AS third_kw
FROM (SELECT *, 0.5*(m_bin*m3/(m_bin+m3))*v2 - 4.302e-3*m_bin*m3/nullif(distance_pc,0) AS e
      FROM candidates) WHERE e < 0""",
    CANDIDATES,
)
oracle(
    "crowded_pairs",
    "singles binaries",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id_1, object_id_2, cm_id, count(*) AS "
    "n_candidates FROM candidates GROUP BY simulation_id, candidates.ttot, object_id_1, "
    "object_id_2, cm_id HAVING count(*) > 1",
    CANDIDATES,
)


def _imbh_test(kw: str, mass: str) -> str:
    return f"({kw} = 14 AND {mass} > 100 AND {mass} < 100000)"


def _imbh_side(i: int) -> str:
    o = 3 - i
    return f"""
SELECT simulation_id, ttot, object_id_{i} AS object_name, 'binary' AS state,
  {i} AS component_index, mass_{i}_msun AS mass_msun, kw_{i} AS kw, r_pc AS radius_pc,
  cm_x_pc AS x_pc, cm_y_pc AS y_pc, cm_z_pc AS z_pc,
  sqrt(cm_vx_kms*cm_vx_kms+cm_vy_kms*cm_vy_kms+cm_vz_kms*cm_vz_kms) AS speed_kms,
  object_id_{o} AS companion_name, mass_{o}_msun AS companion_mass_msun, kw_{o} AS companion_kw,
  least(cast(object_id_1 AS varchar), cast(object_id_2 AS varchar)) || '-' ||
    greatest(cast(object_id_1 AS varchar), cast(object_id_2 AS varchar)) AS binary_pair_key,
  cm_id AS binary_cm_name, mass_1_msun+mass_2_msun AS binary_total_mass_msun,
  semi_major_axis_au AS binary_a_au, eccentricity AS binary_ecc, {TAU} AS tau_gw_myr
FROM pairs WHERE {_imbh_test(f'kw_{i}', f'mass_{i}_msun')}"""


SIGHTINGS = f"""
found AS (SELECT simulation_id, ttot, object_id AS object_name, 'single' AS state,
    cast(NULL AS int) AS component_index, mass_msun, kw, r_pc AS radius_pc, x_pc, y_pc, z_pc,
    {_SPEED} AS speed_kms, cast(NULL AS bigint) AS companion_name,
    cast(NULL AS double) AS companion_mass_msun, cast(NULL AS int) AS companion_kw,
    cast(NULL AS varchar) AS binary_pair_key, cast(NULL AS bigint) AS binary_cm_name,
    cast(NULL AS double) AS binary_total_mass_msun, cast(NULL AS double) AS binary_a_au,
    cast(NULL AS double) AS binary_ecc, cast(NULL AS double) AS tau_gw_myr
  FROM stars WHERE {_imbh_test('kw', 'mass_msun')}
  UNION ALL {_imbh_side(1)} UNION ALL {_imbh_side(2)}),
one AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY simulation_id, ttot, object_name
  ORDER BY state, component_index DESC, companion_name DESC) = 1),
sightings AS (SELECT o.*, o.ttot*s.tscale_myr AS time_myr,
    pow(0.5/s.tidal_1, 1.0/3)*s.rbar_pc AS tidal_radius_pc,
    2*pow(0.5/s.tidal_1, 1.0/3)*s.rbar_pc AS escape_radius_pc,
    radius_pc > 2*pow(0.5/s.tidal_1, 1.0/3)*s.rbar_pc AS is_escape_candidate
  FROM one o LEFT JOIN snapshot_scalars s USING (simulation_id, ttot))"""
_DOUBLES = (
    "ttot mass_msun radius_pc x_pc y_pc z_pc speed_kms companion_mass_msun binary_total_mass_msun "
    "binary_a_au binary_ecc tau_gw_myr time_myr tidal_radius_pc escape_radius_pc"
).split()
oracle(
    "imbh_snapshots",
    "singles binaries scalars",
    f"SELECT simulation_id, object_name, state, {big('component_index')} AS component_index, "
    f"{big('kw')} AS kw, companion_name, {big('companion_kw')} AS companion_kw, binary_pair_key, "
    f"binary_cm_name, is_escape_candidate, {', '.join(f'{r(c)} AS {c}' for c in _DOUBLES)} "
    "FROM sightings",
    STARS,
    PAIRS,
    SIGHTINGS,
)
MERGERS = f"""
known AS (SELECT DISTINCT simulation_id, object_name AS n FROM sightings),
survivors AS (SELECT *, CASE WHEN parent_mass_2_msun > parent_mass_1_msun THEN 2 ELSE 1 END
    AS survivor_parent_index, parent_mass_1_msun + parent_mass_2_msun AS product_mass_msun
  FROM merger_events),
products AS (SELECT *,
    CASE survivor_parent_index WHEN 1 THEN parent_name_1 ELSE parent_name_2 END AS product_name,
    CASE survivor_parent_index WHEN 1 THEN parent_name_2 ELSE parent_name_1 END
      AS discarded_parent_name,
    CASE survivor_parent_index WHEN 1 THEN parent_kw_1 ELSE parent_kw_2 END AS product_kw,
    parent_mass_1_msun = parent_mass_2_msun AS equal_mass_survivor_fallback FROM survivors),
mergers AS (SELECT * FROM (SELECT p.*, {_imbh_test('product_kw', 'product_mass_msun')}
      AS is_imbh_product,
    {_imbh_test('parent_kw_1', 'parent_mass_1_msun')} OR
    {_imbh_test('parent_kw_2', 'parent_mass_2_msun')} OR
    (simulation_id, parent_name_1) IN (SELECT (simulation_id, n) FROM known) OR
    (simulation_id, parent_name_2) IN (SELECT (simulation_id, n) FROM known) AS has_imbh_parent
  FROM products p) WHERE is_imbh_product OR has_imbh_parent)"""
oracle(
    "imbh_mergers",
    "singles binaries scalars merger_events",
    f"""
SELECT simulation_id, seq, {r('ttot')} AS ttot, parent_name_1, parent_name_2,
  {big('parent_kw_1')} AS parent_kw_1, {big('parent_kw_2')} AS parent_kw_2,
  {r('parent_mass_1_msun')} AS parent_mass_1_msun, {r('parent_mass_2_msun')} AS parent_mass_2_msun,
  merger_type, {big('survivor_parent_index')} AS survivor_parent_index, product_name,
  discarded_parent_name, {big('product_kw')} AS product_kw, {r('product_mass_msun')} AS
  product_mass_msun, equal_mass_survivor_fallback, is_imbh_product, has_imbh_parent
FROM mergers""",
    STARS,
    PAIRS,
    SIGHTINGS,
    MERGERS,
)
GENERATIONS = """
ordered AS (SELECT *, row_number() OVER (PARTITION BY simulation_id ORDER BY ttot, seq) AS i
  FROM mergers),
inputs AS (SELECT simulation_id, i, unnest([parent_name_1, parent_name_2]) AS name FROM ordered),
edges AS (SELECT n.simulation_id, n.i, n.name, max(p.i) AS j FROM inputs n JOIN ordered p
  ON n.simulation_id = p.simulation_id AND n.name = p.product_name AND n.i > p.i GROUP BY ALL),
reached(simulation_id, i, g) USING KEY (simulation_id, i) AS (
  SELECT simulation_id, i, cast(1 AS bigint) FROM ordered
  UNION
  SELECT e.simulation_id, e.i, max(p.g) + 1 FROM reached p
    JOIN edges e ON e.simulation_id = p.simulation_id AND e.j = p.i
    JOIN recurring.reached c ON c.simulation_id = e.simulation_id AND c.i = e.i
  GROUP BY e.simulation_id, e.i, c.g HAVING max(p.g) + 1 > c.g),
generations AS (SELECT simulation_id, product_name, max(g) AS generation
  FROM ordered JOIN reached USING (simulation_id, i) GROUP BY ALL)"""
oracle(
    "merger_generations",
    "singles binaries scalars merger_events",
    "SELECT simulation_id, product_name, generation FROM generations",
    STARS,
    PAIRS,
    SIGHTINGS,
    MERGERS,
    GENERATIONS,
)
_OBJECT_ROWS = f"""
SELECT simulation_id, object_name, {r('t0')} AS first_ttot, {r('t1')} AS last_ttot,
  {r('m0')} AS first_time_myr, {r('m1')} AS last_time_myr, {r('heavy')} AS max_mass_msun,
  n AS n_snapshots, states AS states_seen,
  CASE WHEN abs(t0-s0) <= 1e-9 THEN 'already_imbh_at_scan_start'
       WHEN gen >= 2 THEN 'hierarchical_merger' WHEN gen = 1 THEN 'first_generation_merger'
       WHEN n > 1 AND light < heavy THEN 'unlinked_mass_growth' ELSE 'unknown' END
    AS formation_channel, gen AS hierarchical_merger_generation,
  CASE WHEN merged THEN 'merged_into_other' WHEN e0 IS NOT NULL THEN 'escaped_candidate'
       WHEN abs(t1-s1) <= 1e-9 THEN 'retained_candidate'
       WHEN t1 < s1 THEN 'not_seen_at_scan_end' ELSE 'unknown' END AS fate_label,
  product AS fate_product_name, {r('e0')} AS first_escape_ttot, {r('em')} AS first_escape_time_myr
FROM (SELECT o.*, b.s0, b.s1, coalesce(g.generation, 0) AS gen, f.product,
        f.product IS NOT NULL AS merged
  FROM objects o JOIN (SELECT simulation_id, min(ttot) AS s0, max(ttot) AS s1
      FROM snapshot_scalars GROUP BY ALL) b USING (simulation_id)
    LEFT JOIN generations g ON g.simulation_id = o.simulation_id
      AND g.product_name = o.object_name
    LEFT JOIN fates f ON f.simulation_id = o.simulation_id AND f.object_name = o.object_name)"""
_OBJECT_CTES = (
    STARS,
    PAIRS,
    SIGHTINGS,
    MERGERS,
    GENERATIONS,
    "objects AS (SELECT simulation_id, object_name, min(ttot) AS t0, max(ttot) AS t1, "
    "arg_min(time_myr, ttot) AS m0, arg_max(time_myr, ttot) AS m1, max(mass_msun) AS heavy, "
    "min(mass_msun) AS light, count(*) AS n, string_agg(DISTINCT state, ',' ORDER BY state) AS "
    "states, min(ttot) FILTER (is_escape_candidate) AS e0, arg_min(time_myr, ttot) FILTER "
    "(is_escape_candidate) AS em FROM sightings GROUP BY ALL)",
    "fates AS (SELECT m.simulation_id, o.object_name, m.product_name AS product FROM mergers m "
    "JOIN objects o ON o.simulation_id = m.simulation_id AND o.object_name = "
    "m.discarded_parent_name WHERE m.ttot >= o.t1 QUALIFY row_number() OVER (PARTITION BY "
    "m.simulation_id, o.object_name ORDER BY m.ttot, m.seq) = 1)",
)
oracle("imbh_objects", "singles binaries scalars merger_events", _OBJECT_ROWS, *_OBJECT_CTES)
oracle(
    "imbh_counts",
    "singles binaries scalars merger_events",
    "SELECT simulation_id, formation_channel, fate_label, count(*) AS n_objects FROM imbh_rows "
    "GROUP BY ALL",
    *_OBJECT_CTES,
    f"imbh_rows AS ({_OBJECT_ROWS})",
)
_DIR = (
    "winners AS (SELECT simulation_id, ttot, max(mtime) AS mtime, "
    "count(DISTINCT source_hdf5_path) AS n_files, max(source_hdf5_path) FILTER (mtime = top) AS "
    "source_hdf5_path FROM (SELECT *, max(mtime) OVER (PARTITION BY simulation_id, ttot) AS top "
    "FROM steps) GROUP BY simulation_id, ttot)"
)
oracle(
    "ttot_dedup",
    "steps",
    f"SELECT simulation_id, {r('ttot')} AS ttot, source_hdf5_path, {r('mtime')} AS mtime, n_files "
    "FROM winners",
    STEPS,
    _DIR,
)
oracle(
    "ttot_dedup_losers",
    "steps",
    f"SELECT DISTINCT simulation_id, source_hdf5_path, {r('ttot')} AS ttot FROM steps s "
    "WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.simulation_id = s.simulation_id AND "
    "w.ttot = s.ttot AND w.source_hdf5_path = s.source_hdf5_path)",
    STEPS,
    _DIR,
)
oracle(
    "upsert_by_ttot",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id, "
    f"{r('CASE WHEN new THEN 2*mass_msun ELSE mass_msun END')} AS mass_msun FROM ("
    "SELECT *, bool_or(ttot >= 30) OVER (PARTITION BY simulation_id, ttot) AS new "
    "FROM snapshot_singles)",
)
_ORBIT = "rg_x_pc rg_y_pc rg_z_pc vg_x_kmps vg_y_kmps vg_z_kmps".split()
oracle(
    "orbit_dedup",
    "steps scalars",
    f"SELECT simulation_id, {r('ttot')} AS ttot, {r('ttot*tscale_myr')} AS time_myr, "
    f"{', '.join(f'{r(c)} AS {c}' for c in _ORBIT)}, source_hdf5_path, {r('filename_time')} AS "
    "source_file_time, n_star AS source_row_index FROM snapshot_scalars JOIN steps "
    "USING (simulation_id, ttot) QUALIFY row_number() OVER (PARTITION BY simulation_id, ttot "
    "ORDER BY filename_time, source_hdf5_path, n_star) = 1",
    STEPS,
)
oracle(
    "forward_clean",
    "merger_events",
    f"SELECT simulation_id, seq, {r('ttot')} AS ttot FROM (SELECT *, max(ttot) OVER (PARTITION BY "
    "simulation_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS top FROM merger_events) "
    "WHERE ttot = top",
)
oracle(
    "lagr_keep_last",
    "merger_events",
    f"SELECT simulation_id, {r('ttot')} AS ttot, max(seq) AS seq FROM merger_events "
    "GROUP BY simulation_id, merger_events.ttot",
)
oracle(
    "gap_detect",
    "scalars",
    f"SELECT simulation_id, {r('ttot')} AS ttot, {r('p')} AS previous_ttot, {r('ttot-p')} AS gap, "
    "coalesce(abs(ttot - p - 1.0) > 0.1, false) AS is_gap "
    "FROM (SELECT simulation_id, ttot, lag(ttot) OVER (PARTITION BY simulation_id ORDER BY ttot) "
    "AS p FROM snapshot_scalars)",
)
oracle(
    "range_overlap",
    "steps",
    f"SELECT a.d AS run_dir_a, b.d AS run_dir_b, {r('greatest(a.lo,b.lo)')} AS overlap_lo, "
    f"{r('least(a.hi,b.hi)')} AS overlap_hi FROM ranges a JOIN ranges b ON a.d < b.d AND "
    "a.lo <= b.hi AND b.lo <= a.hi",
    "ranges AS (SELECT simulation_id || '/' || run_dir AS d, min(filename_time) AS lo, "
    "max(filename_time) AS hi FROM snapshot_steps GROUP BY 1)",
)
oracle(
    "preflight_totals",
    "steps",
    f"SELECT simulation_id, count(*) AS file_count, {big('sum(b)')} AS total_bytes, "
    f"{big('sum(n)')} AS estimated_row_count, {r('min(lo)')} AS ttot_min, {r('max(hi)')} AS ttot_max "
    "FROM (SELECT simulation_id, source_hdf5_path, max(size_bytes) AS b, sum(n_star) AS n, "
    "min(ttot) AS lo, max(ttot) AS hi FROM steps GROUP BY ALL) GROUP BY simulation_id",
    STEPS,
)
oracle(
    "time_sample",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id, {big('kw')} AS kw, {r('mass_msun')} AS "
    "mass_msun FROM snapshot_singles WHERE abs(ttot/2.5 - round_even(ttot/2.5, 0)) <= 1e-9",
)
oracle(
    "step_metadata",
    "steps",
    f"SELECT simulation_id, source_hdf5_path, count(*) AS n_steps, {r('min(ttot)')} AS ttot_min, "
    f"{r('max(ttot)')} AS ttot_max, {big('sum(n_star)')} AS n_star FROM steps "
    "GROUP BY simulation_id, source_hdf5_path",
    STEPS,
)
oracle(
    "feature_query",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id, {r('mass_msun')} AS mass_msun "
    "FROM snapshot_singles WHERE kw = 14 AND mass_msun BETWEEN 100 AND 160",
)
oracle(
    "orbital_frame",
    "singles scalars",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id,
  {r('(x_pc*rg_x_pc+y_pc*rg_y_pc+z_pc*rg_z_pc)/rn')} AS x_r_pc,
  {r('(x_pc*(ly*rg_z_pc-lz*rg_y_pc)+y_pc*(lz*rg_x_pc-lx*rg_z_pc)+z_pc*(lx*rg_y_pc-ly*rg_x_pc))'
     '/(ln*rn)')} AS x_t_pc,
  {r('(x_pc*lx+y_pc*ly+z_pc*lz)/ln')} AS x_l_pc
FROM snapshot_singles JOIN (SELECT *, sqrt(rg_x_pc*rg_x_pc+rg_y_pc*rg_y_pc+rg_z_pc*rg_z_pc) AS rn,
    sqrt(lx*lx+ly*ly+lz*lz) AS ln FROM (SELECT *, rg_y_pc*vg_z_kmps-rg_z_pc*vg_y_kmps AS lx,
    rg_z_pc*vg_x_kmps-rg_x_pc*vg_z_kmps AS ly, rg_x_pc*vg_y_kmps-rg_y_pc*vg_x_kmps AS lz
    FROM snapshot_scalars)) f USING (simulation_id, ttot)
WHERE rn > 0 AND ln > 0""",
)


def _gamma_series(s: float, x: str) -> str:
    return (
        f"(gamma({s}) * pow({x}, {s}) * exp(-{x}) * list_sum(list_transform(range(160), "
        f"lambda k: exp(k*ln({x}) - lgamma({s} + k + 1)))))"
    )


def _potential(x: str, y: str, z: str) -> str:
    """Milky-Way potential at a position in pc, as one expression."""
    rr = f"(sqrt({x}*{x}+{y}*{y}+{z}*{z})/8000)"
    xx = f"(pow({rr}/{K.MW_BULGE_RC!r}, 2))"
    bulge = (
        f"{K.MW_BULGE_AMP!r}*(2*pi()*pow({K.MW_BULGE_RC!r},0.2)*{_gamma_series(0.1, xx)} - "
        f"2*pi()*pow({K.MW_BULGE_RC!r},1.2)*{_gamma_series(0.6, xx)}/{rr})"
    )
    disk = (
        f"{K.MW_DISK_AMP!r}/sqrt(({x}*{x}+{y}*{y})/6.4e7 + pow({K.MW_DISK_A!r} + "
        f"sqrt({z}*{z}/6.4e7 + pow({K.MW_DISK_B!r},2)), 2))"
    )
    halo = f"{K.MW_HALO_AMP!r}*ln(1+{rr}/2)/{rr}"
    return f"(48400*({bulge} - {disk} - {halo}))"


oracle(
    "galactic_energy",
    "singles scalars",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id, {r('m')} AS mass_msun,
  {r('k', 1)} AS e_kin_specific, {r('p', 1)} AS e_pot_specific, {r('l', 1)} AS l_z_specific,
  {r('k+p', 1)} AS e_gal_specific, {r('m*k', 1)} AS e_kin, {r('m*p', 1)} AS e_pot,
  {r('m*(k+p)', 1)} AS e_gal, {r('m*l', 1)} AS l_z
FROM (SELECT simulation_id, ttot, object_id, m, 0.5*(u*u+v*v+w*w) AS k, (x*v-y*u)/1000 AS l,
    {_potential('x', 'y', 'z')} AS p
  FROM (SELECT simulation_id, ttot, object_id, mass_msun AS m, x_pc+rg_x_pc*rbar_pc AS x,
    y_pc+rg_y_pc*rbar_pc AS y, z_pc+rg_z_pc*rbar_pc AS z, vx_kms+vg_x_kmps*vstar_kms AS u,
    vy_kms+vg_y_kmps*vstar_kms AS v, vz_kms+vg_z_kmps*vstar_kms AS w
    FROM snapshot_singles JOIN snapshot_scalars USING (simulation_id, ttot)))""",
)
oracle(
    "cluster_energy",
    "singles scalars",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, {r('k', 1)} AS e_kin_specific,
  {r('p', 1)} AS e_pot_specific, {r('l', 1)} AS l_z_specific, {r('k+p', 1)} AS e_gal_specific,
  {r('m*k', 1)} AS e_kin, {r('m*p', 1)} AS e_pot, {r('m*(k+p)', 1)} AS e_gal, {r('m*l', 1)} AS l_z
FROM (SELECT simulation_id, ttot, m, 0.5*(u*u+v*v+w*w) AS k, (x*v-y*u)/1000 AS l,
    {_potential('x', 'y', 'z')} AS p
  FROM (SELECT simulation_id, ttot, rg_x_pc*rbar_pc AS x, rg_y_pc*rbar_pc AS y,
    rg_z_pc*rbar_pc AS z, vg_x_kmps*vstar_kms AS u, vg_y_kmps*vstar_kms AS v,
    vg_z_kmps*vstar_kms AS w FROM snapshot_scalars)
  LEFT JOIN (SELECT simulation_id, ttot, avg(mass_msun) AS m FROM snapshot_singles GROUP BY ALL)
    USING (simulation_id, ttot))""",
)
oracle(
    "orbit_elements",
    "binaries",
    f"""
SELECT {_PAIR_ID},
  {r('-m2/(m1+m2)*x')} AS x1_pc, {r('-m2/(m1+m2)*y')} AS y1_pc, {r('-m2/(m1+m2)*z')} AS z1_pc,
  {r('m1/(m1+m2)*x')} AS x2_pc, {r('m1/(m1+m2)*y')} AS y2_pc, {r('m1/(m1+m2)*z')} AS z2_pc,
  {r('a0*m2/(m1+m2)')} AS a1_au, {r('a0*m1/(m1+m2)')} AS a2_au,
  {r('1/nullif(2/nullif(rn,0) - (u*u+v*v+w*w)/mu, 0)', 4)} AS orbit_a, {r('e', 4)} AS orbit_e,
  {r('acos(greatest(-1, least(1, hz/nullif(hn,0))))', 4)} AS orbit_inclination,
  {r('CASE WHEN nn < 1e-14 THEN 0 WHEN atan2(ny,nx) < 0 THEN atan2(ny,nx)+2*pi() '
     'ELSE atan2(ny,nx) END', 4)} AS orbit_node,
  {r('CASE WHEN nn < 1e-14 OR e < 1e-14 THEN 0 WHEN ez < 0 THEN 2*pi()-cw ELSE cw END', 4)}
    AS orbit_periapsis
FROM (SELECT *, acos(greatest(-1, least(1, (nx*ex+ny*ey)/nullif(nn*e,0)))) AS cw FROM (
  SELECT *, sqrt(ex*ex+ey*ey+ez*ez) AS e FROM (
  SELECT *, -hy AS nx, hx AS ny, sqrt(hx*hx+hy*hy) AS nn, sqrt(hx*hx+hy*hy+hz*hz) AS hn,
    (v*hz-w*hy)/mu - x/nullif(rn,0) AS ex, (w*hx-u*hz)/mu - y/nullif(rn,0) AS ey,
    (u*hy-v*hx)/mu - z/nullif(rn,0) AS ez
  FROM (SELECT *, y*w-z*v AS hx, z*u-x*w AS hy, x*v-y*u AS hz, sqrt(x*x+y*y+z*z) AS rn
  FROM (SELECT simulation_id, ttot, object_id_1, object_id_2, mass_1_msun AS m1,
    mass_2_msun AS m2, semi_major_axis_au AS a0, {K.G_PC_KMS2_MSUN!r}*(mass_1_msun+mass_2_msun) AS mu,
    rel_x_pc AS x, rel_y_pc AS y, rel_z_pc AS z, rel_vx_kms AS u, rel_vy_kms AS v, rel_vz_kms AS w
    FROM snapshot_binaries)))))""",
)


def _bin(value: str, part: str) -> str:
    lo, hi = (f"{f}({value}) OVER (PARTITION BY {part})" for f in ("min", "max"))
    return (
        f"cast(CASE WHEN {hi} > {lo} THEN least(floor(({value}-{lo})/({hi}-{lo})*100), 99) "
        "ELSE 0 END AS bigint)"
    )


oracle(
    "hist2d_loglog",
    "binaries",
    f"SELECT simulation_id, bin_0, bin_1, count(*) AS n FROM (SELECT simulation_id, "
    f"{_bin('log10(mass_1_msun)', 'simulation_id')} AS bin_0, "
    f"{_bin('log10(semi_major_axis_au)', 'simulation_id')} AS bin_1 FROM snapshot_binaries "
    "WHERE mass_1_msun > 0 AND semi_major_axis_au > 0) GROUP BY ALL",
)
oracle(
    "hist1d_mass",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, bin_0, count(*) AS n FROM (SELECT simulation_id, "
    f"ttot, {_bin('mass_msun', 'simulation_id, ttot')} AS bin_0 FROM snapshot_singles) t "
    "GROUP BY simulation_id, t.ttot, bin_0",
)
_PCT = ", ".join(
    f"{r(f'quantile_cont({c}, {p})')} AS {c}_{n}"
    for c in ("vx_kms", "luminosity_lsun")
    for n, p in (("low", 0.001), ("high", 0.999))
)
oracle(
    "percentile_limits",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, {_PCT} FROM snapshot_singles "
    "GROUP BY simulation_id, snapshot_singles.ttot",
)
_RANGE = ", ".join(
    f"{r(f'{f}({c})')} AS {f}_{c}"
    for c in ("mass_msun", "luminosity_lsun", "teff_k")
    for f in ("min", "max")
)
oracle(
    "axis_range",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, {_RANGE} FROM snapshot_singles "
    "GROUP BY simulation_id, snapshot_singles.ttot",
)
oracle(
    "display_attributes",
    "singles",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id,
  {r('(log10(l)-log10(lo))/nullif(log10(hi)-log10(lo),0)')} AS alpha,
  {r('0.12 + sqrt((greatest(least(mass_msun,100.0),0.1)-0.1)/99.9)*0.73')} AS display_radius,
  {r('pow(sqrt(10) + (log10(greatest(radius_rsun,0.0004))-log10(0.0004))/'
     '(log10(2000)-log10(0.0004))*(100-sqrt(10)), 2)')} AS marker_size
FROM (SELECT *, luminosity_lsun AS l, min(luminosity_lsun) OVER w AS lo,
  max(luminosity_lsun) OVER w AS hi FROM snapshot_singles
  WINDOW w AS (PARTITION BY simulation_id, ttot))""",
)
oracle(
    "type_counts",
    "binaries",
    f"SELECT simulation_id, {pair_type('kw_1', 'kw_2')} AS stellar_type, count(*) AS n "
    "FROM snapshot_binaries WHERE kw_1 BETWEEN 10 AND 14 OR kw_2 BETWEEN 10 AND 14 GROUP BY 1, 2",
)
_M1, _M2 = "parent_mass_1_msun", "parent_mass_2_msun"
_EVENT = f"""
  {r(f'greatest({_M1},{_M2})')} AS primary_mass_msun,
  {r(f'least({_M1},{_M2})/greatest({_M1},{_M2})')} AS mass_ratio,
  {pair_type('parent_kw_1', 'parent_kw_2')} AS stellar_type, merger_type"""
oracle(
    "text_events",
    "merger_events",
    f"SELECT simulation_id, seq, {r('ttot')} AS ttot, parent_name_1, parent_name_2, "
    f"{r(f'least({_M1},{_M2})')} AS secondary_mass_msun, "
    f"{big('greatest(parent_kw_1,parent_kw_2)')} AS primary_kw, "
    f"{big('least(parent_kw_1,parent_kw_2)')} AS secondary_kw, {_EVENT} FROM merger_events",
)
oracle(
    "compact_mergers",
    "merger_events",
    f"SELECT simulation_id, seq, {_EVENT} FROM merger_events "
    "WHERE parent_kw_1 BETWEEN 10 AND 14 AND parent_kw_2 BETWEEN 10 AND 14",
)
oracle(
    "stream_ingest",
    "steps",
    f"SELECT simulation_id, {r('ttot')} AS ttot, {r('mtime')} AS mtime, source_hdf5_path "
    "FROM winners",
    STEPS,
    _DIR,
)
oracle(
    "compact_object_store",
    "singles binaries",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, object_id, 'BH' AS object_type, {r('m')} AS mass_msun
FROM (SELECT simulation_id, ttot, object_id, kw, mass_msun AS m FROM snapshot_singles
  UNION ALL SELECT simulation_id, ttot, object_id_1, kw_1, mass_1_msun FROM snapshot_binaries
  UNION ALL SELECT simulation_id, ttot, object_id_2, kw_2, mass_2_msun FROM snapshot_binaries)
WHERE kw = 14 AND m > 50""",
)
oracle(
    "density_uncentred",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id, {r('x_pc')} AS x_pc, {r('y_pc')} AS "
    f"y_pc, {r('z_pc')} AS z_pc FROM snapshot_singles",
)
oracle(
    "backfill_accuracy",
    "binaries",
    f"SELECT count(*) AS n_known, {r('avg(cast(t = p AS int))')} AS accuracy FROM (SELECT "
    f"bin_label AS t, {_DERIVED_LABEL} AS p FROM snapshot_binaries WHERE bin_label <> -9)",
)
oracle(
    "nzero_consistent",
    "binaries",
    f"SELECT simulation_id, coalesce(min(cm_id) FILTER (bin_label = 1) > {_NZERO}, true) AS "
    "nzero_consistent FROM snapshot_binaries GROUP BY simulation_id",
)
oracle(
    "nzero_inferred",
    "scalars",
    "SELECT simulation_id, n AS nzero FROM snapshot_scalars WHERE ttot = 0",
)
oracle(
    "shared_snapshots",
    "steps",
    f"SELECT DISTINCT a.run AS run_dir_a, b.run AS run_dir_b, {r('a.ttot')} AS ttot FROM runs a "
    "JOIN runs b ON a.run < b.run AND a.ttot = b.ttot JOIN ranges x ON x.run = a.run "
    "JOIN ranges y ON y.run = b.run WHERE x.lo <= y.hi AND y.lo <= x.hi",
    "runs AS (SELECT simulation_id || '/' || run_dir AS run, ttot, filename_time "
    "FROM snapshot_steps)",
    "ranges AS (SELECT run, min(filename_time) AS lo, max(filename_time) AS hi FROM runs "
    "GROUP BY run)",
)
oracle(
    "duplicate_file_times",
    "steps",
    f"SELECT simulation_id, run_dir, {r('filename_time')} AS filename_time, source_hdf5_path, "
    "n_dirs, n_files FROM (SELECT *, count(*) OVER w AS n_dirs, count(*) OVER w AS n_files FROM "
    "(SELECT DISTINCT simulation_id, run_dir, filename_time, source_hdf5_path FROM steps) "
    "WINDOW w AS (PARTITION BY simulation_id, filename_time)) WHERE n_dirs > 1",
    STEPS,
)
_TOTALS = f"count(*) AS n, {r('sum(mass_msun)')} AS mass_msun"
for _name in ("stream_singles", "lake_after_crash"):
    oracle(
        _name,
        "singles",
        f"SELECT simulation_id, {r('ttot')} AS ttot, {_TOTALS} FROM snapshot_singles "
        "GROUP BY simulation_id, ttot",
    )
oracle(
    "lake_incremental",
    "singles steps",
    f"SELECT s.simulation_id, {r('s.ttot')} AS ttot, w.source_hdf5_path, {_TOTALS} "
    "FROM snapshot_singles s JOIN (SELECT simulation_id, ttot, "
    "max_by(source_hdf5_path, (mtime, source_hdf5_path)) AS source_hdf5_path FROM steps "
    "WHERE filename_time <> 0 GROUP BY simulation_id, ttot) w "
    "ON s.simulation_id = w.simulation_id AND s.ttot = w.ttot "
    "GROUP BY s.simulation_id, s.ttot, w.source_hdf5_path",
    STEPS,
)

_ASKED = "asked AS (SELECT simulation_id, parent_name_1 AS object_id, ttot, seq FROM merger_events)"
_FOUND = ("ttot", "kw", "mass_msun", "state", "companion_id")


def _asof(name: str, compare: str) -> str:
    return (
        f"{name} AS (SELECT a.*, h.ttot AS h_ttot, h.kw AS h_kw, h.mass_msun AS h_mass_msun, h.state AS h_state, "
        f"h.companion_id AS h_companion_id FROM asked a ASOF LEFT JOIN history h ON a.simulation_id = h.simulation_id "
        f"AND a.object_id = h.object_id AND a.ttot {compare} h.ttot)"
    )


_ASKED_COLUMNS = (
    f"simulation_id, object_id, {r('ttot')} AS ttot, seq, {r('h_ttot')} AS found_ttot, {big('h_kw')} AS found_kw, "
    f"{r('h_mass_msun')} AS found_mass_msun, h_state AS found_state, h_companion_id AS found_companion_id"
)
for _name, _compare in (("history_before_merger", ">="), ("history_after_merger", "<=")):
    oracle(_name, "singles binaries merger_events", f"SELECT {_ASKED_COLUMNS} FROM found", HISTORY, _ASKED, _asof("found", _compare))
_nearer = "p.h_ttot IS NULL OR n.h_ttot - n.ttot < p.ttot - p.h_ttot"
oracle(
    "history_near_merger",
    "singles binaries merger_events",
    f"SELECT {_ASKED_COLUMNS} FROM found",
    HISTORY,
    _ASKED,
    _asof("p", ">="),
    _asof("n", "<="),
    "found AS (SELECT p.simulation_id, p.object_id, p.ttot, p.seq, "
    + ", ".join(f"CASE WHEN {_nearer} THEN n.h_{c} ELSE p.h_{c} END AS h_{c}" for c in _FOUND)
    + " FROM p JOIN n USING (simulation_id, object_id, ttot, seq))",
)
oracle(
    "companion_lanes",
    "singles binaries",
    f"""
SELECT simulation_id, object_id, companion_id, {big('lane')} AS lane, {r('lo')} AS first_ttot, {r('hi')} AS last_ttot FROM (
  WITH RECURSIVE spans AS (
    SELECT *, row_number() OVER (PARTITION BY simulation_id, object_id ORDER BY lo, hi, companion_id) AS k FROM (
      SELECT simulation_id, object_id, companion_id, min(ttot) AS lo, max(ttot) AS hi FROM history
      WHERE companion_id IS NOT NULL GROUP BY ALL)),
  walk AS (
    SELECT simulation_id, object_id, companion_id, lo, hi, k, 1 AS lane, [hi] AS ends FROM spans WHERE k = 1
    UNION ALL
    SELECT simulation_id, object_id, companion_id, lo, hi, k, lane,
      list_concat(list_concat(ends[1:lane-1], [hi]), ends[lane+1:]) FROM (
        SELECT s.*, w.ends, coalesce(list_filter(range(1, len(w.ends) + 1), lambda i: w.ends[i] < s.lo)[1], len(w.ends) + 1) AS lane
        FROM walk w JOIN spans s ON s.simulation_id = w.simulation_id AND s.object_id = w.object_id AND s.k = w.k + 1))
  SELECT * FROM walk)""",
    HISTORY,
)
oracle(
    "mass_profile",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id, {r('r_pc')} AS r_pc, count(*) OVER w AS n_inside, "
    f"{r('sum(mass_msun) OVER w')} AS mass_inside_msun FROM stars "
    "WINDOW w AS (PARTITION BY simulation_id, ttot ORDER BY r_pc, object_id ROWS UNBOUNDED PRECEDING)",
    STARS,
)
oracle(
    "stream_snapshots",
    "singles binaries scalars steps",
    " UNION ALL ".join(
        f"SELECT simulation_id, {r('ttot')} AS ttot, source_hdf5_path, '{_t}' AS part, count(*) AS n, {r(f'sum({_m})')} AS mass_msun "
        f"FROM snapshot_{_t} JOIN won USING (simulation_id, ttot) GROUP BY ALL"
        for _t, _m in (("singles", "mass_msun"), ("binaries", "mass_1_msun"), ("scalars", "zmbar_msun"))
    ),
    STEPS,
    "won AS (SELECT simulation_id, ttot, max_by(source_hdf5_path, (mtime, source_hdf5_path)) AS source_hdf5_path "
    "FROM steps GROUP BY simulation_id, ttot)",
)
oracle(
    "feature_range",
    "singles binaries",
    f"""
SELECT simulation_id, {r('ttot')} AS ttot, CASE kw WHEN 14 THEN 'BH' WHEN 13 THEN 'NS' ELSE 'WD' END AS object_type,
  count(*) AS n, {r('sum(m)')} AS mass_msun
FROM (SELECT simulation_id, ttot, kw, mass_msun AS m FROM snapshot_singles
  UNION ALL SELECT simulation_id, ttot, kw_1, mass_1_msun FROM snapshot_binaries
  UNION ALL SELECT simulation_id, ttot, kw_2, mass_2_msun FROM snapshot_binaries)
WHERE kw BETWEEN 10 AND 14 AND ttot BETWEEN 20 AND 30 GROUP BY ALL""",
)

_CURVES = ", ".join(
    f"({w!r}, {a!r}, {b!r}, {c!r})" for w, (a, b, c) in zip(WAVELENGTHS_NM.tolist(), matching_curves().T.tolist())
)
_ROWS = dict(zip("rgb", XYZ_TO_RGB.tolist()))
oracle(
    "star_colours",
    "singles",
    f"SELECT simulation_id, {r('ttot')} AS ttot, object_id, {r('teff_k')} AS teff_k, "
    + ", ".join(f"{r(f'CASE WHEN {c} / top <= 0.0031308 THEN 12.92 * {c} / top ELSE 1.055 * pow({c} / top, 1 / 2.4) - 0.055 END')} AS {c}" for c in "rgb")
    + " FROM snapshot_singles JOIN colours USING (teff_k)",
    f"curves AS (SELECT * FROM (VALUES {_CURVES}) v(w, cx, cy, cz))",
    f"light AS (SELECT teff_k, pow(w, -5) / (exp({C2_NM_K!r} / (w * teff_k)) - 1) AS e, cx, cy, cz "
    "FROM (SELECT DISTINCT teff_k FROM snapshot_singles), curves)",
    "xyz AS (SELECT teff_k, sum(e * cx) AS x, sum(e * cy) AS y, sum(e * cz) AS z FROM light GROUP BY teff_k)",
    "linear AS (SELECT teff_k, "
    + ", ".join(f"greatest(({p!r} * x + {q!r} * y + {s!r} * z) / (x + y + z), 0) AS {c}" for c, (p, q, s) in _ROWS.items())
    + " FROM xyz)",
    "colours AS (SELECT *, greatest(r, g, b) AS top FROM linear)",
)
