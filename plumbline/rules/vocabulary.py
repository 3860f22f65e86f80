"""The controlled vocabularies, patterns and limits of the rule packs."""

COUNTRIES = (
    "US", "GB", "NG", "DE", "FR", "CA", "SG", "AE", "ZA", "NL",
    "CH", "IE", "IN", "BR", "AU", "JP", "HK", "LU",
)
ENTITY_TYPES = (
    "Public Company", "Private Company", "Fund", "SPV", "Government Entity", "Financial Institution",
)
ENTITY_STATUSES = ("Active", "Inactive", "Merged", "Dissolved", "Unknown")
ISSUER_INSTRUMENTS = ("Equity", "Bond", "Fund", "Commercial Paper", "Private Credit")
ENTITY_RISK_RATINGS = ("Low", "Medium", "High", "Critical")

CURRENCIES = ("USD", "GBP", "EUR", "NGN", "JPY", "CHF", "CAD", "AUD")
TRADE_INSTRUMENTS = ("Equity", "Bond", "Fund", "Private Credit", "Private Equity", "Derivative")
TRADE_KYC_STATUSES = ("Approved", "Pending", "Rejected", "Expired")
TRADE_RISK_RATINGS = ("Low", "Medium", "High")

WEAK_NAMES = ("Unknown Counterparty",)
ORPHAN_ISSUER_PREFIX = "ISS-ORPHAN"
ISIN_PATTERN = "^[A-Z]{2}[A-Z0-9]{10}$"
LEI_PATTERN = "^[A-Z0-9]{20}$"

FRESH_DAYS = 365
LOW_CONFIDENCE = 0.70
LARGE_NOTIONAL = 10_000_000.0

# Values whose intended spelling is beyond doubt; everything else is left for review.
CURRENCY_FIXES = {"EURO": "EUR", "US": "USD", "U.S.D": "USD", "UKP": "GBP"}
COUNTRY_FIXES = {"UK": "GB"}
INSTRUMENT_FIXES = {"Equityy": "Equity"}

# Tokens that a CSV reader of the data-frame kind takes for missing values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
