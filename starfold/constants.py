"""Fixed physical constants, thresholds and code tables."""

import math

# CODATA 2018 / IAU 2015 constants, SI.
G_SI = 6.6743e-11
C_SI = 299792458.0
AU_M = 149597870700.0
MSUN_KG = 1.988409870698051e30
MYR_S = 3.15576e13

# Unit conversions.
PC_TO_AU = 206264.80624709636
SOLRAD_TO_AU = 0.004650467260962157

# Fixed value: G in pc (km/s)^2 / Msun, used by the triple finder.
G_PC_KMS2_MSUN = 4.302e-3

# 5 c^5 au^4 / (64 G^3 Msun^3), expressed in Myr: tau_gw for a=1 au, mu*M^2 = 1 Msun^3, e=0.
TAU_GW_MYR = 5.0 * C_SI**5 * AU_M**4 / (64.0 * G_SI**3 * MSUN_KG**3) / MYR_S

# Classification thresholds.
TEMPORARY_EBIND_FACTOR = 1.0e-3
UNIVERSE_AGE_MYR = 13800.0
IMBH_MIN_MSUN = 100.0
IMBH_MAX_MSUN = 1.0e5
EXTREME_MASS_RATIO_UPPER = 0.1
HIGH_BH_ECC_LOWER = 0.1
PISN_GAP_MSUN = (64.0, 161.0)
HALO_STAR_R_PC = 20.0
HALO_STAR_V_KMS = 50.0
B_TYPE_TEFF_K = (10500.0, 31500.0)
B_TYPE_MASS_MSUN = (2.75, 17.7)
BIN_LABEL_UNKNOWN = -9
RELATIVISTIC_CM_KW = -25
CHAOTIC_TIDE_CM_KW = -1
COMMON_ENVELOPE_OFFSET = 100
MISSING_FILES_BEFORE_STOP = 5
TRIPLE_SEARCH_FACTOR = 1000.0

# Stellar-type codes.
NS_KW = 13
BH_KW = 14
WD_KW = (10, 11, 12)
COMPACT_KW = (10, 11, 12, 13, 14)
STELLAR_TYPES = {
    -1: "PMS",
    0: "LMS",
    1: "MS",
    2: "HG",
    3: "GB",
    4: "CHeB",
    5: "EAGB",
    6: "TPAGB",
    7: "HeMS",
    8: "HeHG",
    9: "HeGB",
    10: "HeWD",
    11: "COWD",
    12: "ONeWD",
    13: "NS",
    14: "BH",
    15: "MLR",
}

# Plot limits that also clip the displayed L*/Teff* of NS and BH.
DISPLAY_LIMITS = {
    "L*": (0.000009, 100000000.0),
    "Teff*": (1000.0, 1050000.0),
    "R*": (0.0004, 2000.0),
}

# Lagrangian mass fractions, as printed in the suffixes of lagr.7 columns.
LAGR_FRACTIONS = (
    "1.00E-03",
    "3.00E-03",
    "5.00E-03",
    "1.00E-02",
    "3.00E-02",
    "5.00E-02",
    "1.00E-01",
    "2.00E-01",
    "3.00E-01",
    "4.00E-01",
    "5.00E-01",
    "6.00E-01",
    "7.00E-01",
    "8.00E-01",
    "9.00E-01",
    "9.50E-01",
    "9.90E-01",
    "1.00E+00",
)
LAGR_CORE = "<RC"

# Profile metrics, in output order.
LAGR_METRICS = (
    "rlagr",
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


def percent_label(suffix: str) -> str:
    """Printed percentage of a Lagrangian suffix: one decimal below 1 %, none above."""
    if suffix == LAGR_CORE:
        return suffix
    value = float(suffix)
    return f"{value:.1%}" if value < 0.01 else f"{value:.0%}"


# Milky-Way potential (power-law bulge with cutoff, Miyamoto-Nagai disk, NFW halo),
# lengths in units of 8 kpc, amplitudes giving unit circular speed (220 km/s) at 8 kpc.
MW_RO_KPC = 8.0
MW_VO_KMS = 220.0
MW_BULGE_RC = 1.9 / 8.0
MW_DISK_A = 3.0 / 8.0
MW_DISK_B = 0.28 / 8.0
MW_HALO_A = 2.0
MW_BULGE_AMP = 0.029994597188218328
MW_DISK_AMP = 0.7574802019371595
MW_HALO_AMP = 4.852230533527998
GAMMA_0_6 = math.gamma(0.6)
GAMMA_0_1 = math.gamma(0.1)
