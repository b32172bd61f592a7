"""Fixed values of the Treasury futures universe. All of them are defaults that callers may replace."""

# Front-contract security -> maturity in years.
UNIVERSE = {"TU1": 2, "FV1": 5, "TY1": 7, "UXY1": 10, "WN1": 30}

# Constant-maturity series are named with this prefix and the maturity.
TENOR_PREFIX = "DGS"

# Names of the risk variables in the deliverable table.
RISK_VARIABLES = {
    "CONVENTIONAL_CTD_FORWARD_FRSK": "duration",
    "FUT_EQV_CNVX_NOTL": "convexity",
}

# Tenor -> ETF ticker. "DSG7" is misspelled in the data this map belongs to, so tenor 7
# finds no ETF; pass a corrected map to get one.
ETF_TICKERS = {"DGS2": "SHY", "DGS10": "IEF", "DGS5": "IEI", "DGS30": "TLT", "DSG7": "IEF"}

# Quote sides, the sides filled with the row mean, and the outlier rule.
QUOTE_SIDES = ("bid", "eod", "mid", "offer")
IMPUTED_SIDES = ("bid", "eod")
ZSCORE_WINDOW = 200
ZSCORE_CUTOFF = 6.0

# Names of the observed-security vintages, most trusted first.
VINTAGES = ("auctioned_after_2000", "auctioned_after_2005", "auctioned_after_2010")

# Day counts.
CARRY_DAYS = 360
DAYS_PER_WEEK = 7

# Columns of the synthetic return table that the strategies carry for each leg.
RETURN_VARIABLES = ("duration", "convexity", "yld", "yld_diff", "dur_rtn", "cvx_rtn", "bnd_rtn")
