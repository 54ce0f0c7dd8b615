"""Cleaning rules per data family, as data.

Column names, codes and year limits below are fixed values: they are properties of the
published releases.
"""

from __future__ import annotations

from ridgepole.operators.rules import (
    NullFrom,
    NumberAfterPrefix,
    ReadDate,
    Recode,
    Rule,
    Scale,
    ScaleToWhole,
    NullIfIn,
    before,
    sentinels,
    since,
)

# --- bank acquisitions ----------------------------------------------------------

# The release changed its units in 2019.
UNITS_CHANGED = 2019

# Columns published as fractions before the change.
PERCENT_COLUMNS = (
    "LTV Ratio Percent",
    "Note Rate Percent",
    "Housing Expense Ratio Percent",
    "Total Debt Expense Ratio Percent",
    "PMI Coverage Percent",
)

# Indicators that used 2 for "no" before the change.
INDICATOR_COLUMNS = (
    "Borrower First Time Homebuyer Indicator",
    "Employment Borrower Self Employment Indicator",
)

# Codes that stand for "not reported".
ACQUISITION_CODES = {
    "Unit 1 - Number of Bedrooms": [98],
    "Unit 2 - Number of Bedrooms": [98],
    "Unit 3 - Number of Bedrooms": [98],
    "Unit 4 - Number of Bedrooms": [98],
    "Index Source Type": [99],
    "Borrower 1 Age at Application Years Count": [99, 999],
    "Borrower 2 Age at Application Years Count": [98, 99, 998, 999],
    "Housing Expense Ratio Percent": [999, 999.99],
    "Total Debt Expense Ratio Percent": [999, 999.99],
    "Core Based Statistical Area Code": [99999],
    "Margin Rate Percent": [9999, 99999],
    "Geographic Names Information System (GNIS) Feature ID": [9999999999],
    "Unit 1 - Reported Rent": [9999999999],
    "Unit 2 - Reported Rent": [9999999999],
    "Unit 3 - Reported Rent": [9999999999],
    "Unit 4 - Reported Rent": [9999999999],
    "Unit 1 - Reported Rent Plus Utilities": [9999999999],
    "Unit 2 - Reported Rent Plus Utilities": [9999999999],
    "Unit 3 - Reported Rent Plus Utilities": [9999999999],
    "Unit 4 - Reported Rent Plus Utilities": [9999999999],
}


def acquisition_rules(file_year: int, changed: int = UNITS_CHANGED) -> list[Rule]:
    """Rules for one yearly file, in the order they must run.

    Scaling comes before code removal, so an old ``999`` in a scaled column is removed
    by the bound, not by its code.
    """
    old, new = before("Year", changed), since("Year", changed)
    expiry = ("Prepayment Penalty Expiration Date",)
    if file_year < changed:
        dates = ReadDate(expiry, "M/d/yyyy", ("12/31/9999",))
    else:
        dates = ReadDate(expiry, "yyyy-M-d", ("9999-12-31",))
    return [
        Scale(PERCENT_COLUMNS, 100, old),
        Scale(("Total Yearly Income Amount",), 12, new),
        Recode(INDICATOR_COLUMNS, 2, 0, old),
        ScaleToWhole(("Census Tract Identifier",), 100),
        NumberAfterPrefix(("Property Type",), "PT"),
        NullFrom(("Total Debt Expense Ratio Percent", "Housing Expense Ratio Percent"), 1000),
        *sentinels(ACQUISITION_CODES),
        dates,
    ]


# Text columns of the acquisitions files; the rest is numeric.
ACQUISITION_TEXT = ("Property Type", "Prepayment Penalty Expiration Date")

# --- bank members ---------------------------------------------------------------

# Drifting member headers, after upper-casing.
MEMBER_NAMES = {
    "FHFBID": "FHFB ID",
    "FHFA ID": "FHFB ID",
    "MEM NAME": "MEMBER NAME",
    "MEM TYPE": "MEMBER TYPE",
    "CHAR TYPE": "CHARTER TYPE",
    "APPR DATE": "APPROVAL DATE",
    "CERT": "FDIC CERTIFICATE NUMBER",
    "FED ID": "FEDERAL RESERVE ID",
    "OTS ID": "OTS DOCKET NUMBER",
    "NCUA ID": "CREDIT UNION CHARTER NUMBER",
}

# Member sheets with title rows above the header.
MEMBER_SKIP_ROWS = {"FHLB_Members_Q12020_Release": 1}

# First quarter whose dates are text with two-digit years.
TEXT_DATES_FROM = (2014, 3)

# --- single-family loans --------------------------------------------------------

# Fixed values: (column spellings, codes that stand for "not reported").
LOAN_CODES: list[tuple[tuple[str, ...], list[float]]] = [
    (("Borrower(s) Annual Income", "Borrower’s (or Borrowers’) Annual Income"), [999999998]),
    (("Discount Points",), [999999]),
    (
        (
            "Loan-to-Value Ratio (LTV) at Origination, or Combined LTV (CLTV)",
            "Loan-to-Value Ratio (LTV) at Origination, or Combined LTV (CLTV) where available",
        ),
        [999],
    ),
    (("Debt-to-Income (DTI) Ratio",), [99]),
    (("Note Amount",), [999999999]),
    (("Property Value",), [999999999]),
    (("Introductory Rate Period",), [999]),
    (("Number of Borrowers",), [99]),
    (("First-Time Home Buyer",), [9]),
    (tuple(f"Borrower Race or National Origin {n}" for n in range(1, 6)), [9]),
    (tuple(f"Co-Borrower Race or National Origin {n}" for n in range(1, 6)), [9]),
    (("Borrower Ethnicity",), [4, 9]),
    (("Co-Borrower Ethnicity",), [4, 9]),
    (("Borrower Gender", "Borrower Sex"), [4, 9]),
    (("Co-Borrower Gender", "Co-Borrower Sex"), [4, 9]),
    (("Age of Borrower (binned per CFPB specification)", "Age of Borrower"), [9]),
    (("Age of Co-Borrower (binned per CFPB specification)", "Age of Co-Borrower"), [9]),
    (("HOEPA Status",), [9]),
    (("Borrower Age 62 or older",), [9]),
    (("Co-Borrower Age 62 or older",), [9]),
    (("Preapproval",), [9]),
    (("Application Channel",), [9]),
    (("Manufactured Home - Land Property Interest",), [9]),
    (("Interest Rate at Origination",), [99]),
    (("Automated Underwriting System (AUS) Name",), [6, 9]),
    (("Credit Score Model - Borrower",), [9, 99]),
    (("Credit Score Model - Co-Borrower",), [9, 99]),
]


def loan_rules() -> list[Rule]:
    return [NullIfIn(spellings, codes) for spellings, codes in LOAN_CODES]


# Names of the two census vintages' key columns.
TRACT_2010 = ("US Postal State Code", "County - 2010 Census", "Census Tract - 2010 Census")
TRACT_2020 = ("US Postal State Code", "County - 2020 Census", "Census Tract - 2020 Census")

# Incomes published under a name that carries the year.
YEARLY_INCOMES = ("Area Median Family Income", "Local Area Median Income")

# --- multifamily loans ----------------------------------------------------------

# Column names of the multifamily census files since 2018.
MULTIFAMILY_NAMES = [
    "Enterprise Flag",
    "Record Number",
    "US Postal State Code",
    "Metropolitan Statistical Area",
    "County",
    "Census Tract",
    "Census Tract Percent Minority",
    "Census Tract Median Income",
    "Local Area Median Income",
    "Tract Income Ratio",
    "Area Median Family Income",
    "Acquisition Unpaid Principal Balance",
    "Purpose of Loan",
    "Type of Seller Institution",
    "Federal Guarantee",
    "Lien Status",
    "Loan to Value",
    "Date of Mortgage Note",
    "Term of Mortgage at Origination",
    "Number of Units",
    "Interest Rate at Origination",
    "Note Amount",
    "Property Value",
    "Prepayment Penalty Term",
    "Balloon Payment",
    "Interest Only",
    "Negative Amortization",
    "Other Nonamortizing Features",
    "Multifamily Affordable Units Percent",
    "Construction Method",
    "Rural Census Tract",
    "Lower Mississippi Delta County",
    "Middle Appalachia County",
    "Persistent Poverty County",
    "Area of Concentrated Poverty",
    "High Opportunity Area",
    "Qualified Opportunity Zone",
]
