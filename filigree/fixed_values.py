"""Fixed values. They are part of the data model: results match only if these
words, patterns and formats are exactly as stated here."""

# Numeric tag (local name) -> metric, 34 tags into 25 metrics.
METRIC_TAGS = {
    "TurnoverRevenue": "revenue",
    "Turnover": "revenue",
    "Revenue": "revenue",
    "TurnoverGrossOperatingRevenue": "revenue",
    "GrossProfitLoss": "gross_profit",
    "GrossProfit": "gross_profit",
    "OperatingProfitLoss": "operating_profit",
    "ProfitLossBeforeTax": "profit_before_tax",
    "ProfitLossOnOrdinaryActivitiesBeforeTax": "profit_before_tax",
    "TaxTaxCreditOnProfitOrLossOnOrdinaryActivities": "tax",
    "ProfitLoss": "profit_after_tax",
    "ProfitLossForPeriod": "profit_after_tax",
    "ComprehensiveIncomeExpense": "comprehensive_income",
    "CurrentAssets": "current_assets",
    "TradeDebtorsTradeReceivables": "trade_debtors",
    "Debtors": "debtors",
    "DebtorsTradeOther": "debtors",
    "CashBankOnHand": "cash",
    "CashBankInHand": "cash",
    "CashCashEquivalents": "cash",
    "TotalAssetsLessCurrentLiabilities": "total_assets_less_current_liabilities",
    "Creditors": "creditors",
    "TradeCreditorsTradePayables": "trade_creditors",
    "NetCurrentAssetsLiabilities": "net_current_assets",
    "NetAssetsLiabilities": "net_assets",
    "Equity": "equity",
    "ShareholderFunds": "shareholder_funds",
    "CalledUpShareCapital": "share_capital",
    "AverageNumberEmployeesDuringPeriod": "avg_employees",
    "NetCashFlowsFromUsedInOperatingActivities": "cashflow_operating",
    "NetCashFlowsFromUsedInInvestingActivities": "cashflow_investing",
    "NetCashFlowsFromUsedInFinancingActivities": "cashflow_financing",
    "NetCashGeneratedFromOperations": "net_cash_from_operations",
    "CashCashEquivalentsCashFlowValue": "cash_at_period_end",
}

# Text tag (local name) -> metadata field, 21 tags.
FIELD_TAGS = {
    "EntityCurrentLegalOrRegisteredName": "company_name",
    "UKCompaniesHouseRegisteredNumber": "company_number_filed",
    "StartDateForPeriodCoveredByReport": "period_start",
    "EndDateForPeriodCoveredByReport": "period_end",
    "BalanceSheetDate": "balance_sheet_date",
    "AccountsType": "accounts_type",
    "AccountingStandardsApplied": "accounting_standard",
    "AccountsStatusAuditedOrUnaudited": "audit_status",
    "EntityDormantTruefalse": "is_dormant",
    "EntityTradingStatus": "trading_status",
    "LegalFormEntity": "legal_form",
    "NameEntityAuditors": "auditor_name",
    "DescriptionPrincipalActivities": "principal_activities",
    "AddressLine1": "address_line_1",
    "AddressLine2": "address_line_2",
    "PrincipalLocation-CityOrTown": "city",
    "CountyRegion": "county",
    "PostalCodeZip": "postcode",
    "NameParentEntity": "parent_entity",
    "NameSubsidiary": "subsidiary_name",
    "DescriptionNatureTransactionsBalancesWithRelatedParties": "related_party_xbrl",
}

# Tags with a role of their own.
COMPANY_NAME_TAG = "EntityCurrentLegalOrRegisteredName"
DIRECTOR_TAG = "NameEntityOfficer"
RELATED_PARTY_TAG = "DescriptionNatureTransactionsBalancesWithRelatedParties"
RELATED_PARTY_FIELD = "related_party_xbrl"
RELATED_PARTY_SECTION = "related_party_disclosures_xbrl"

# Month numbers and names used in labels.
MONTHS = {
    "01": "January",
    "02": "February",
    "03": "March",
    "04": "April",
    "05": "May",
    "06": "June",
    "07": "July",
    "08": "August",
    "09": "September",
    "10": "October",
    "11": "November",
    "12": "December",
}

# Section headings, tried in this order; the first match wins.
SECTION_STARTS = (
    (r"^(GROUP\s+)?STRATEGIC\s+REPORT", "strategic_report"),
    (r"^(REPORT\s+OF\s+THE\s+)?DIRECTORS['’]?\s*REPORT", "directors_report"),
    (r"^RELATED\s+PARTY\s+(DISCLOSURES|TRANSACTIONS)", "related_party_disclosures"),
    (r"^(ULTIMATE\s+)?CONTROLL(ING|ED)\s+PARTY", "ultimate_controlling_party"),
)

# Headings that end any section.
SECTION_STOPS = (
    r"^REPORT\s+OF\s+THE\s+INDEPENDENT",
    r"^INDEPENDENT\s+AUDITOR",
    r"^STATEMENT\s+OF\s+COMPREHENSIVE",
    r"^BALANCE\s+SHEET",
    r"^CONSOLIDATED\s+STATEMENT\s+OF\s+(COMPREHENSIVE|FINANCIAL|CHANGES)",
    r"^NOTES\s+TO\s+THE",
    r"^CASH\s+FLOW\s+STATEMENT",
    r"^DIRECTORS['’]?\s+RESPONSIBILITIES",
    r"^STATEMENT\s+OF\s+CHANGES\s+IN\s+EQUITY",
    r"^COMPANY\s+INFORMATION",
)

# Lines left out of section text.
SECTION_SKIPS = (
    r"^Page\s+\d",
    r"^-\s*\d+\s*-$",
    r"^\d+$",
    r"^FOR\s+THE\s+(YEAR|PERIOD)\s+ENDED",
    r"^REGISTERED\s+NUMBER",
)

# A bare note number ends the sections that are notes.
NOTE_NUMBER = r"^\d{1,2}\.\s*$"
NOTE_SECTIONS = ("related_party_disclosures", "ultimate_controlling_party")
MIN_SECTION_CHARS = 11
MIN_RELATED_PARTY_CHARS = 21

# Marks of group accounts, in tags and in running text.
GROUP_TAG_MARKS = ("ConsolidatedGroupCompanyAccounts", "APConsolidation")
GROUP_TAG_PAIR = ("GroupCompanyDataDimension", "Consolidated")
GROUP_TEXT_PATTERNS = (
    r"consolidated\s+(financial\s+)?statement",
    r"group\s+(strategic|accounts|financial)",
)

# Snapshot CSV header -> column (the first header really starts
# with a blank).
SNAPSHOT_HEADERS = {
    " CompanyNumber": "company_number",
    "CompanyName": "company_name",
    "RegAddress.AddressLine1": "address_line_1",
    "RegAddress.AddressLine2": "address_line_2",
    "RegAddress.PostTown": "post_town",
    "RegAddress.County": "county",
    "RegAddress.Country": "country",
    "RegAddress.PostCode": "postcode",
    "RegAddress.CareOf": "care_of",
    "RegAddress.POBox": "po_box",
    "CompanyCategory": "company_category",
    "CompanyStatus": "company_status",
    "CountryOfOrigin": "country_of_origin",
    "DissolutionDate": "dissolution_date",
    "IncorporationDate": "incorporation_date",
    "Accounts.AccountRefDay": "accounts_ref_day",
    "Accounts.AccountRefMonth": "accounts_ref_month",
    "Accounts.NextDueDate": "accounts_next_due_date",
    "Accounts.LastMadeUpDate": "accounts_last_made_up",
    "Accounts.AccountCategory": "accounts_category",
    "Returns.NextDueDate": "returns_next_due_date",
    "Returns.LastMadeUpDate": "returns_last_made_up",
    "SICCode.SicText_1": "sic_code_1",
    "SICCode.SicText_2": "sic_code_2",
    "SICCode.SicText_3": "sic_code_3",
    "SICCode.SicText_4": "sic_code_4",
}

# Snapshot gate, comment length, ledger comments, text formats.
SNAPSHOT_TOLERANCE = 0.95
COMMENT_CHARS = 2000
SUCCESS_COMMENT = "Processed successfully"
WARNING_MARK = "ixt"
FILE_HEAD = "FILE: "
WARNING_HEAD = ("\nParsed with ", " warning(s) — data SAVED (only flagged fields were skipped):\n")
FILING_SOURCE = "accounts"
SNAPSHOT_SOURCE = "company_data"
ARCHIVE_PREFIX = "Accounts_Monthly_Data-"

# Inline XBRL transformation formats, by local name, from the
# public transformation registries 1 to 4.
DOT_DECIMAL_FORMATS = ("numdotdecimal", "num-dot-decimal", "numcommadot", "numspacedot")
COMMA_DECIMAL_FORMATS = (
    "numcommadecimal", "num-comma-decimal", "numdotcomma", "numspacecomma", "numcomma",
)
ZERO_FORMATS = ("zerodash", "numdash", "fixedzero", "fixed-zero")
EMPTY_FORMATS = ("nocontent", "fixedempty", "fixed-empty")
TRUE_FORMATS = ("booleantrue", "fixedtrue", "fixed-true")
FALSE_FORMATS = ("booleanfalse", "fixedfalse", "fixed-false")
DAY_MONTH_YEAR_FORMATS = (
    "datedaymonthyear", "date-day-month-year", "datedoteu", "dateslasheu",
)
MONTH_DAY_YEAR_FORMATS = (
    "datemonthdayyear", "date-month-day-year", "datedotus", "dateslashus",
)
YEAR_MONTH_DAY_FORMATS = ("dateyearmonthday", "date-year-month-day")
DAY_MONTHNAME_YEAR_FORMATS = (
    "datedaymonthyearen", "date-day-monthname-year-en", "datelonguk", "dateshortuk",
)

# The code points that Python's str.strip() removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# What the bytes 0x80-0x9F mean in cp1252; U+FFFD where undefined.
CP1252_HIGH = bytes(range(0x80, 0xA0)).decode("cp1252", errors="replace")

# Own text, no fixed value: the ledger comment of a filing that gave no rows.
EMPTY_COMMENT = "Empty result"
