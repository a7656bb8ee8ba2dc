"""Stellar-type labels, centre-of-mass state codes and bin_label reconstruction."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from starfold import constants as K
from starfold.functions.numeric import ColumnLike, col


def _type_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(K.STELLAR_TYPES.items())])


def kw_name(kw: ColumnLike) -> Column:
    """Abbreviation of a KW code; NULL for an unknown code."""
    return F.try_element_at(_type_map(), col(kw).cast("int"))


def kw_verbose(kw: ColumnLike) -> Column:
    """Right-aligned code and abbreviation, such as ' 1:MS' or '14:BH'."""
    return F.concat(F.lpad(col(kw).cast("string"), 2, " "), F.lit(":"), kw_name(kw))


def pair_type(kw1: ColumnLike, kw2: ColumnLike) -> Column:
    """'BH-NS' style label, the higher code first."""
    a, b = col(kw1), col(kw2)
    return F.concat(kw_name(F.greatest(a, b)), F.lit("-"), kw_name(F.least(a, b)))


def resolve_kw(stellar_type: str | None = None, kw: int | str | None = None) -> int:
    """Target code from exactly one of an abbreviation (any case) or a code."""
    if (stellar_type is None) == (kw is None):
        raise ValueError("give exactly one of stellar_type and kw")
    if kw is not None:
        try:
            code = int(kw)
        except (TypeError, ValueError) as exc:
            raise ValueError(f"not a KW code: {kw!r}") from exc
        if code not in K.STELLAR_TYPES:
            raise ValueError(f"unknown KW code {code}")
        return code
    codes = {name.upper(): code for code, name in K.STELLAR_TYPES.items()}
    name = str(stellar_type).strip().upper()
    if name not in codes:
        raise ValueError(f"unknown stellar type {stellar_type!r}")
    return codes[name]


def object_type(kw: ColumnLike) -> Column:
    k = col(kw)
    return (
        F.when(k == K.BH_KW, "BH")
        .when(k == K.NS_KW, "NS")
        .when(k.isin(*K.WD_KW), "WD")
        .otherwise("unknown")
    )


def _is_odd(c: Column) -> Column:
    return F.pmod(c, F.lit(2)) == 1


def cm_state(cm_kw: ColumnLike) -> dict[str, Column]:
    """Decoded centre-of-mass code: odd from 11 is ongoing mass transfer, even above 10 is past."""
    k = col(cm_kw).cast("int")
    high = k >= 10
    ongoing = high & _is_odd(k)
    return {
        "is_standard": k == 0,
        "mt_ongoing": ongoing,
        "mt_past": high & ~_is_odd(k) & (k > 10),
        "mt_phase_index": F.when(ongoing, ((k - 9) / 2).cast("int"))
        .when(high, ((k - 10) / 2).cast("int"))
        .otherwise(0),
        "is_relativistic_binary": k == K.RELATIVISTIC_CM_KW,
        "is_chaotic_tide_binary": k == K.CHAOTIC_TIDE_CM_KW,
    }


def member_kw(kw: ColumnLike) -> tuple[Column, Column]:
    """(stellar type, in common envelope): codes above 100 carry the envelope flag."""
    k = col(kw).cast("int")
    in_ce = k > K.COMMON_ENVELOPE_OFFSET
    return F.when(in_ce, k - K.COMMON_ENVELOPE_OFFSET).otherwise(k), in_ce


def reconstructed_bin_label(
    nzero: ColumnLike | int,
    *,
    label: ColumnLike = "bin_label",
    cm_id: ColumnLike = "cm_id",
    id1: ColumnLike = "object_id_1",
    id2: ColumnLike = "object_id_2",
    gamma: ColumnLike = "pert_gamma",
    cm_kw: ColumnLike = "cm_kw",
) -> Column:
    """Known labels stay; label -9 is derived from ids, perturbation and state, in rule order."""
    n = F.lit(nzero) if isinstance(nzero, int) else col(nzero)
    cm, g = col(cm_id), col(gamma).cast("float")
    member = cm - n
    derived = (
        F.when(cm < 0, -1)
        .when((g == F.lit(0.0).cast("float")) & (col(cm_kw) == K.CHAOTIC_TIDE_CM_KW), 0)
        .when((cm > n) & ((member == col(id1)) | (member == col(id2))), 1)
        .when(g == F.lit(0.1).cast("float"), -1)
        .otherwise(K.BIN_LABEL_UNKNOWN)
    )
    return F.when(col(label) == K.BIN_LABEL_UNKNOWN, derived).otherwise(col(label)).cast("int")
