"""Fixed values of the accounting checks: concept names, dimensions and word lists."""

from __future__ import annotations

TOLERANCE_PCT = 5.0

# Single concepts.
ASSETS, LIABILITIES, LIABILITIES_AND_EQUITY = "us-gaap:Assets", "us-gaap:Liabilities", "us-gaap:LiabilitiesAndStockholdersEquity"
GROSS_PROFIT, OPERATING_EXPENSES, OPERATING_INCOME = "us-gaap:GrossProfit", "us-gaap:OperatingExpenses", "us-gaap:OperatingIncomeLoss"

# Temporary equity.
TEMPORARY_PRIMARY = (
    "us-gaap:TemporaryEquityCarryingAmountAttributableToParent",
    "us-gaap:TemporaryEquityCarryingAmountIncludingPortionAttributableToNoncontrollingInterests",
)
TEMPORARY_PARTS = ("TemporaryEquityCarryingAmountAttributableToParent", "TemporaryEquityCarryingAmountIncludingPortionAttributableToNoncontrollingInterests")
TEMPORARY_MEZZANINE = (
    "us-gaap:RedeemableNoncontrollingInterestEquityCarryingAmount",
    "us-gaap:RedeemableNoncontrollingInterestEquityPreferredCarryingAmount",
    "us-gaap:RedeemableNoncontrollingInterestEquityCommonCarryingAmount",
    "us-gaap:RedeemableNoncontrollingInterestEquityOtherCarryingAmount",
)
TEMPORARY_OTHER = (
    "us-gaap:TemporaryEquityValueExcludingAdditionalPaidInCapital",
    "us-gaap:TemporaryEquityAggregateAmountOfRedemptionRequirement",
    "us-gaap:TemporaryEquityLiquidationPreference",
    "us-gaap:SharesSubjectToMandatoryRedemptionSettlementTermsAmount",
)

# Equity.
EQUITY = ("us-gaap:StockholdersEquity", "us-gaap:StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest")
EQUITY_TOTALS = ("Parent", "ParentMember")
EQUITY_COMPONENTS = (
    "CommonStock",
    "OrdinaryShares",
    "CommonClassA",
    "CommonClassB",
    "CommonClassC",
    "CommonClassX",
    "OtherAdditionalCapital",
    "PreferredStock",
    "AdditionalPaidInCapital",
    "RetainedEarnings",
    "AccumulatedOtherComprehensiveIncome",
    "TreasuryStockCommon",
    "ReserveforESOPDebtRetirement",
    "TreasuryStockCommonAndPreferred",
    "CommonStockIncludingAdditionalPaidInCapital",
)
# The same for quarterly reports.
QUARTERLY_EQUITY_COMPONENTS = (
    "CommonStock",
    "PreferredStock",
    "AdditionalPaidInCapital",
    "RetainedEarnings",
    "AccumulatedOtherComprehensiveIncome",
    "TreasuryStockCommon",
    "ReserveforESOPDebtRetirement",
    "TreasuryStockCommonAndPreferred",
    "CommonStockIncludingAdditionalPaidInCapital",
    "AccumulatedDistributionsInExcessOfNetIncome",
)
# Forms that are judged by the annual rules, besides those that begin with 10-K.
ANNUAL_FORMS = ("20-F", "40-F")
AOCI_PARENTS = ("AccumulatedOtherComprehensiveIncome", "AociIncludingPortionAttributableToNoncontrollingInterest")
AOCI_CHILDREN = (
    "AccumulatedNetInvestmentGainLossIncludingPortionAttributableToNoncontrollingInterest",
    "AccumulatedDefinedBenefitPlansAdjustmentNetGainLossIncludingPortionAttributableToNoncontrollingInterest",
    "AccumulatedForeignCurrencyAdjustmentIncludingPortionAttributableToNoncontrollingInterest",
    "AccumulatedGainLossNetCashFlowHedgeParent",
    "AccumulatedTranslationAdjustment",
    "AccumulatedNetUnrealizedInvestmentGainLoss",
    "AccumulatedDefinedBenefitPlansAdjustment",
)

# Income statement.
REVENUE = ("us-gaap:RevenueFromContractWithCustomerExcludingAssessedTax", "us-gaap:Revenues", "us-gaap:NetSales")
COST = ("us-gaap:CostOfGoodsAndServicesSold", "us-gaap:CostOfRevenue")
PRETAX = (
    "us-gaap:IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
    "us-gaap:IncomeLossFromContinuingOperationsBeforeIncomeTaxes",
    "us-gaap:IncomeLossBeforeIncomeTaxes",
)
TAX = ("us-gaap:IncomeTaxExpenseBenefit", "us-gaap:IncomeTaxExpenseBenefitContinuingOperationsDiscontinuedOperationsExtraordinaryItems")
NET = ("us-gaap:NetIncomeLoss", "us-gaap:ProfitLoss")
OCI = (
    "us-gaap:OtherComprehensiveIncomeLossNetOfTaxPortionAttributableToParent",
    "us-gaap:OtherComprehensiveIncomeLossNetOfTax",
    "us-gaap:OtherComprehensiveIncomeLossNetOfTaxPortionAttributableToParent [AccumulatedOtherComprehensiveIncome]",
    "us-gaap:OtherComprehensiveIncomeLossNetOfTax [AccumulatedOtherComprehensiveIncome]",
    "us-gaap:OtherComprehensiveIncomeNetOfTaxPortionAttributableToParent",
    "us-gaap:OtherComprehensiveIncomeNetOfTax",
)
COMPREHENSIVE = ("us-gaap:ComprehensiveIncomeNetOfTax", "us-gaap:ComprehensiveIncomeNetOfTaxIncludingPortionAttributableToNoncontrollingInterest")
OTHER_OPEX = (
    "us-gaap:RestructuringAndRelatedCostIncurredCost",
    "us-gaap:RestructuringAndRelatedCosts",
    "us-gaap:BusinessCombinationAcquisitionRelatedCosts",
    "us-gaap:OtherOperatingIncomeExpenseNet",
)
RESEARCH, SELLING = "us-gaap:ResearchAndDevelopmentExpense", "us-gaap:SellingGeneralAndAdministrativeExpense"

# Cash flow.
OPERATING = ("us-gaap:NetCashProvidedByUsedInOperatingActivities", "us-gaap:NetCashProvidedByUsedInOperatingActivitiesContinuingOperations")
INVESTING = ("us-gaap:NetCashProvidedByUsedInInvestingActivities", "us-gaap:NetCashProvidedByUsedInInvestingActivitiesContinuingOperations")
FINANCING = ("us-gaap:NetCashProvidedByUsedInFinancingActivities", "us-gaap:NetCashProvidedByUsedInFinancingActivitiesContinuingOperations")
CASH_CHANGE = (
    "us-gaap:CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseIncludingExchangeRateEffect",
    "us-gaap:CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseIncludingExchangeRateEffectContinuingOperations",
    "us-gaap:CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseExcludingExchangeRateEffect",
)
EXCHANGE_EFFECT = (
    "us-gaap:EffectOfExchangeRateOnCashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsIncludingDisposalGroupAndDiscontinuedOperations",
    "us-gaap:EffectOfExchangeRateOnCashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
)
DISCONTINUED = "us-gaap:NetCashProvidedByUsedInDiscontinuedOperations"
DISCONTINUED_PARTS = (
    "us-gaap:CashProvidedByUsedInOperatingActivitiesDiscontinuedOperations",
    "us-gaap:CashProvidedByUsedInInvestingActivitiesDiscontinuedOperations",
    "us-gaap:CashProvidedByUsedInFinancingActivitiesDiscontinuedOperations",
)

# Nonoperating items.
NONOP_TOTALS = ("us-gaap:NonoperatingIncomeExpense", "us-gaap:OtherIncomeExpenseNet", "us-gaap:TotalOtherIncomeExpenseNet", "us-gaap:InterestIncomeExpenseNonoperatingNet")
INTEREST_NET = ("us-gaap:InterestIncomeExpenseNetNonoperating", "us-gaap:InterestIncomeExpenseNet", "us-gaap:InterestIncomeExpenseNonoperatingNet")
INTEREST_PARTS = ("us-gaap:InterestIncomeNonoperating", "us-gaap:InterestExpenseNonoperating", "us-gaap:InterestIncome", "us-gaap:InterestExpense")
INVESTMENT_INCOME = ("us-gaap:InvestmentIncomeNonoperating", "us-gaap:InvestmentIncomeNet", "us-gaap:InvestmentIncomeInterest")
OTHER_NONOP = (
    "us-gaap:OtherNonoperatingIncomeExpenseNet",
    "us-gaap:OtherNonoperatingIncomeExpense",
    "us-gaap:InterestAndOtherIncome",
    "us-gaap:InterestAndDebtExpense",
    "us-gaap:InterestAndOtherIncomeLoss",
)
EXTRA_NONOP = (
    "us-gaap:InterestExpenseOther",
    "us-gaap:InterestExpenseDebt",
    "us-gaap:InterestExpenseDebtExcludingAmortization",
    "us-gaap:ForeignCurrencyTransactionGainLossBeforeTax",
    "us-gaap:ForeignCurrencyTransactionGainLoss",
    "us-gaap:GainLossOnDerivativeInstrumentsNetPretax",
    "us-gaap:GainLossOnDerivativeInstrumentsHeldForTradingPurposesNet",
    "us-gaap:RealizedInvestmentGainsLosses",
    "us-gaap:UnrealizedGainLossOnInvestments",
    "us-gaap:MarketableSecuritiesGainLossExcludingOtherThanTemporaryImpairments",
    "us-gaap:GainsLossesOnExtinguishmentOfDebt",
    "us-gaap:GainsLossesOnExtinguishmentOfDebtBeforeWriteOffOfDeferredDebtIssuanceCost",
    "us-gaap:EquityMethodInvestmentEarningsLoss",
    "us-gaap:IncomeLossFromEquityMethodInvestments",
)
STATEMENT_EXCLUDES = (
    "cash",
    "increase",
    "decrease",
    "payment",
    "payments",
    "paid",
    "proceeds",
    "repayment",
    "issuance",
    "purchase",
    "acquire",
    "disposal",
    "capitalexpend",
    "depreciation",
    "amortization",
    "assets",
    "liabilit",
    "equity",
    "receivable",
    "payable",
    "inventory",
    "propertyplant",
    "rightofuse",
    "lease",
    "debtinstrument",
    "shares",
    "stock",
    "dividend",
    "dividends",
    "earningspershare",
    "eps",
    "netincome",
    "profitloss",
    "comprehensiveincome",
    "beforeincometaxes",
    "incomelossfromcontinuingoperations",
    "incomelossfromdiscontinuedoperations",
    "discontinuedoperation",
    "discontinuedoperations",
)
STATEMENT_INCLUDES = (
    "nonoperat",
    "otherincome",
    "otherexpense",
    "other income",
    "other expense",
    "interest",
    "investment",
    "dividend",
    "foreigncurrency",
    "fx",
    "deriv",
    "fairvalue",
    "remeasure",
    "extinguish",
    "gain",
    "loss",
    "warrant",
    "equitymethod",
)
COMPONENT_EXCLUDES = (
    "operatingincomeloss",
    "netincomeloss",
    "profitloss",
    "comprehensiveincome",
    "beforeincometaxes",
    "incomelossfromcontinuingoperations",
    "incomelossfromdiscontinuedoperations",
    "discontinuedoperation",
    "discontinuedoperations",
    "incometax",
)

# Segments.
SEGMENTS = ("AmericasSegment", "EuropeSegment", "GreaterChinaSegment", "JapanSegment", "RestOfAsiaPacificSegment")

# Labels of early statements.
LEGACY_ASSETS = ("Total Assets",)
LEGACY_LIABILITIES_AND_EQUITY = ("Total Liabilities And Stockholders' Equity", "Total Liabilities And Shareholders' Equity", "Total Liabilities And Equity")
LEGACY_REVENUE = ("Total Revenues", "Net Sales", "Revenues", "Revenue")
LEGACY_COST = ("Cost Of Goods Sold", "Cost Of Sales", "Cost Of Revenues", "Costs And Expenses")
LEGACY_GROSS = ("Gross Profit", "Gross Margin")
LEGACY_OPERATING = ("Operating Income", "Income From Operations")
LEGACY_PRETAX = ("Income Before Income Taxes", "Income Before Taxes")
LEGACY_TAX = ("Income Taxes", "Provision For Income Taxes", "Income Tax Expense")
LEGACY_NET = ("Net Income", "Net Loss", "Net Earnings")
LEGACY_CFO = ("Net Cash Provided By Operating Activities", "Net Cash Provided By Used In Operating Activities")
LEGACY_CFI = ("Net Cash Used In Investing Activities", "Net Cash Provided By Used In Investing Activities")
LEGACY_CFF = ("Net Cash Used In Financing Activities", "Net Cash Provided By Financing Activities", "Net Cash Provided By Used In Financing Activities")
LEGACY_CASH_CHANGE = ("Net Increase In Cash", "Net Decrease In Cash", "Net Increase Decrease In Cash")
