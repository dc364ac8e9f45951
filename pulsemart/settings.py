"""Parameters of every operator: lexicons, weights, thresholds and rule tables.

Everything is a frozen dataclass or a plain tuple, so an operator can be run
with other vocabularies without touching its logic.  The blocks headed
"Fixed values" are data that results depend on, not logic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Social tone lexicons (whole-word match, positive list first)
# --------------------------------------------------------------------------
TWITTER_POSITIVE = ("love", "great", "excellent", "amazing", "best", "good", "thank", "thanks")
TWITTER_NEGATIVE = ("hate", "terrible", "awful", "worst", "bad", "horrible", "sucks", "disappointed")
TWITTER_TOXIC = ("damn", "shit", "fuck", "wtf", "stupid", "idiot")
REDDIT_POSITIVE = ("love", "great", "excellent", "amazing", "best", "good", "recommend", "solid")
REDDIT_NEGATIVE = ("hate", "terrible", "awful", "worst", "bad", "horrible", "avoid", "scam")
REDDIT_TOXIC = ("damn", "shit", "fuck", "wtf", "stupid", "idiot", "asshole")


@dataclass(frozen=True)
class ToneLexicon:
    """Whole-word lists and the scores they give to a post."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]
    toxic: tuple[str, ...]
    positive_score: float = 0.5
    negative_score: float = -0.5
    toxic_score: float = 0.8
    calm_score: float = 0.1


TWITTER_TONE = ToneLexicon(TWITTER_POSITIVE, TWITTER_NEGATIVE, TWITTER_TOXIC)
REDDIT_TONE = ToneLexicon(REDDIT_POSITIVE, REDDIT_NEGATIVE, REDDIT_TOXIC)


# --------------------------------------------------------------------------
# Complaint and severity substrings of the raw layer
# --------------------------------------------------------------------------
COMPLAINT_TERMS = (
    "problem", "issue", "complaint", "error", "wrong",
    "bad", "terrible", "awful", "frustrated", "angry",
)
SEVERITY_TERMS = (
    ("high", ("fraud", "scam", "illegal", "lawsuit", "attorney")),
    ("medium", ("problem", "issue", "error", "wrong")),
)
SEVERITY_DEFAULT = "low"
SEVERITY_CUTS = (("high", 0.7), ("medium", 0.3))
SEVERITY_AS_SCORE = {"high": 0.8, "medium": 0.5, "low": 0.2}
SEVERITY_AS_NUMBER = {"high": 1.0, "medium": 0.5}

PRODUCT_TERMS = (
    ("Mortgage", ("mortgage",)),
    ("Credit Card", ("credit card",)),
    ("Deposit Account", ("checking", "savings")),
    ("Loan", ("loan",)),
    ("Debt Collection", ("debt collection",)),
)
PRODUCT_DEFAULT = "Other"


# --------------------------------------------------------------------------
# Text enricher (substring match)
# --------------------------------------------------------------------------
ENRICH_POSITIVE = ("good", "great", "excellent", "love", "amazing", "perfect", "best", "happy", "satisfied")
ENRICH_NEGATIVE = ("bad", "terrible", "awful", "hate", "worst", "horrible", "angry", "frustrated", "disappointed")
ENRICH_SEVERE = ("fraud", "scam", "stolen", "hack", "security", "breach", "locked", "frozen", "emergency")
BANK_TOPICS = (
    "checking_account", "savings_account", "mobile_app", "online_banking", "atm",
    "td_ameritrade", "td_auto_finance", "td_mortgage", "td_credit_card",
    "td_student_loans", "td_business_banking",
    "fees", "overdraft", "account_lock", "fraud", "security_breach",
    "customer_service", "branch_service", "phone_support", "wait_times",
    "ux", "website_issues", "app_crashes", "login_problems", "outage",
    "system_down", "maintenance",
    "interest_rates", "rewards", "cashback", "credit_score", "loan_approval",
    "mortgage_rates", "refinancing", "investment_options",
    "cross_border_banking", "currency_exchange", "international_transfers",
    "canada_us_banking",
)
URL_PATTERN = (
    r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
)


@dataclass(frozen=True)
class EnrichSettings:
    positive: tuple[str, ...] = ENRICH_POSITIVE
    negative: tuple[str, ...] = ENRICH_NEGATIVE
    severe: tuple[str, ...] = ENRICH_SEVERE
    topics: tuple[str, ...] = BANK_TOPICS
    max_topics: int = 3
    min_chars: int = 10
    sentiment_step: float = 0.2
    severity_step: float = 0.3
    limit: float = 0.8
    confidence: float = 0.6
    language: str = "en"
    scorer_name: str = "lexicon"
    scorer_version: str = "v1.0"


# --------------------------------------------------------------------------
# Complaint features (word lists are whole-word, patterns raw)
# --------------------------------------------------------------------------
FEATURE_WORDS = (
    ("account_terms", ("account", "checking", "savings", "deposit")),
    ("card_terms", ("card", "credit", "debit", "payment")),
    ("loan_terms", ("loan", "mortgage", "finance", "debt")),
    ("fee_terms", ("fee", "charge", "cost", "money", "dollar")),
    ("channel_terms", ("atm", "branch", "online", "mobile", "app")),
    ("fraud_terms", ("fraud", "scam", "unauthorized", "stolen")),
    ("service_terms", ("customer service", "support", "representative", "call")),
    ("error_terms", ("error", "mistake", "wrong", "incorrect")),
    ("closure_terms", ("close", "closed", "closure", "terminate")),
    ("dispute_terms", ("dispute", "disagree", "unfair", "unreasonable")),
    ("negative_sentiment", ("terrible", "awful", "horrible", "worst", "hate")),
    ("emotional_terms", ("frustrated", "angry", "upset", "disappointed")),
)
FEATURE_PATTERNS = (
    ("inability_terms", "can.t|cannot|unable|won.t|will not"),
    ("frequency_terms", "never|always|every time|constantly"),
)


@dataclass(frozen=True)
class FeatureSettings:
    words: tuple[tuple[str, tuple[str, ...]], ...] = FEATURE_WORDS
    patterns: tuple[tuple[str, str], ...] = FEATURE_PATTERNS

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.words) + tuple(n for n, _ in self.patterns)


# --------------------------------------------------------------------------
# Cluster rules, first match wins
# (features that must all be present, cluster name, description)
# --------------------------------------------------------------------------
CLUSTER_RULES = (
    (("fraud_terms",), "fraud_security", "Fraud, scams, unauthorized transactions, and security issues"),
    (("account_terms", "error_terms"), "account_errors", "Account errors, incorrect balances, and banking mistakes"),
    (("account_terms", "closure_terms"), "account_closure", "Account closures and termination issues"),
    (("account_terms",), "account_issues", "General account management and banking issues"),
    (("card_terms", "fee_terms"), "card_fees", "Credit/debit card fees and charges"),
    (("card_terms",), "card_issues", "Credit/debit card functionality and issues"),
    (("loan_terms", "dispute_terms"), "loan_disputes", "Loan disputes, disagreements, and conflicts"),
    (("loan_terms",), "loan_issues", "Loan, mortgage, and financing issues"),
    (("service_terms", "emotional_terms"), "poor_service", "Poor customer service experiences"),
    (("service_terms",), "service_issues", "Customer service and support issues"),
    (("fee_terms", "dispute_terms"), "fee_disputes", "Fee disputes and billing disagreements"),
    (("fee_terms",), "fee_issues", "Fees, charges, and billing issues"),
    (("channel_terms", "error_terms"), "tech_errors", "ATM, online, and mobile app technical errors"),
    (("channel_terms",), "channel_issues", "ATM, branch, online, and mobile channel issues"),
    (("dispute_terms",), "general_disputes", "General disputes and disagreements"),
    (("negative_sentiment", "emotional_terms"), "negative_experience", "Highly negative customer experiences"),
)
CLUSTER_DEFAULT = ("general_complaints", "General complaints and miscellaneous issues")
# (features that must all be present, severity label or None, priority)
PRIORITY_RULES = (
    (("fraud_terms",), None, 1),
    ((), "high", 2),
    (("emotional_terms", "negative_sentiment"), None, 3),
    (("dispute_terms",), None, 4),
    ((), "medium", 5),
)
PRIORITY_DEFAULT = 6


# --------------------------------------------------------------------------
# Composite score
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Weights:
    social: float = 0.30
    search: float = 0.20
    complaints: float = 0.25
    reviews_customer: float = 0.15
    reviews_employee: float = 0.10


@dataclass(frozen=True)
class FourPartWeights:
    """Alternative score: social is half tone, half volume; one reviews term."""

    social: float = 0.30
    search: float = 0.20
    complaints: float = 0.25
    reviews: float = 0.25
    sentiment_part: float = 0.5
    customer_part: float = 0.6


@dataclass(frozen=True)
class ScoreSettings:
    neutral: float = 50.0
    risk_cuts: tuple[tuple[float, str], ...] = (
        (30.0, "High Risk"), (50.0, "Medium Risk"), (70.0, "Low Risk"),
    )
    risk_default: str = "Healthy"
    direction_cut: float = 10.0
    critical_score: float = 25.0
    notable_change: float = 20.0
    short_lag: int = 7
    long_lag: int = 28
    calc_version: str = "v1.0"


@dataclass(frozen=True)
class DailySettings:
    twitter_min_posts: int = 10
    reddit_min_messages: int = 5
    trends_min_points: int = 5
    complaints_min: int = 1
    high_engagement: int = 10
    high_upvote: float = 0.8
    long_narrative: int = 500
    tone_cut: float = 0.1
    toxic_cut: float = 0.7
    tone_anomaly_factor: float = 2.0
    tone_anomaly_spread: float = 0.5
    trends_anomaly_mean: float = 90.0
    trends_anomaly_change: float = 500.0
    complaints_anomaly_count: int = 100
    complaints_anomaly_severity: float = 0.9
    top_keywords: int = 5


@dataclass(frozen=True)
class TrendSplit:
    """Recent against earlier volume of one cluster."""

    days: int = 7
    min_active_days: int = 7
    rising: float = 1.2
    falling: float = 0.8
    balanced: bool = False


@dataclass(frozen=True)
class AlertSettings:
    severity: float = 0.70
    volume_increase: float = 50.0


# --------------------------------------------------------------------------
# retrieval
# --------------------------------------------------------------------------
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)


@dataclass(frozen=True)
class Bm25:
    k1: float = 1.2
    b: float = 0.75


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------
BRAND_ROWS = (
    ("jpm", "JPMorgan Chase", ("JPMorgan", "Chase Bank", "Chase"), ("chase.com", "jpmorgan.com"), "JPM", "US"),
    ("wf", "Wells Fargo", ("Wells Fargo Bank", "WF"), ("wellsfargo.com",), "WFC", "US"),
    ("bac", "Bank of America", ("BofA", "Bank of America Corporation"), ("bankofamerica.com",), "BAC", "US"),
    ("c", "Citibank", ("Citi", "Citigroup", "Citicorp"), ("citi.com", "citibank.com"), "C", "US"),
    ("gs", "Goldman Sachs", ("Goldman", "GS"), ("goldmansachs.com",), "GS", "US"),
    ("ms", "Morgan Stanley", ("MS",), ("morganstanley.com",), "MS", "US"),
    ("td", "TD Bank", ("TD", "Toronto-Dominion Bank", "TD Bank Group"), ("td.com", "tdbank.com"), "TD", "CA"),
)
BRAND_ALIASES = {"td_bank": "td"}

COMPANY_NAMES = (
    ("chase", ("JPMORGAN CHASE & CO.",)),
    ("bank_of_america", ("BANK OF AMERICA, NATIONAL ASSOCIATION",)),
    ("wells_fargo", ("WELLS FARGO & COMPANY",)),
    ("capital_one", ("CAPITAL ONE FINANCIAL CORPORATION",)),
    ("citibank", ("CITIBANK, N.A.",)),
    ("pnc", ("PNC Bank N.A.",)),
    ("santander", ("SANTANDER BANK, NATIONAL ASSOCIATION", "SANTANDER HOLDINGS USA, INC.")),
    ("td_bank", ("TD BANK USA, NATIONAL ASSOCIATION",)),
    ("citizens_bank", ("CITIZENS BANK, NATIONAL ASSOCIATION",)),
    ("mt_bank", ("M&T BANK CORPORATION",)),
    ("keybank", ("KEYBANK NATIONAL ASSOCIATION",)),
    ("regions_bank", ("REGIONS BANK",)),
    ("truist", ("TRUIST BANK",)),
)


# Default mention dictionary.  Repeated entries and case variants count as the
# mention rules say, so the list is kept as it is.
TD_BANK_TERMS = (
    "TD Bank", "TD Bank N.A.", "TD Bank USA", "TD Bank US", "TD Bank National Association",
    "Toronto Dominion Bank", "Toronto-Dominion Bank", "Toronto Dominion", "Toronto-Dominion",
    "The Toronto-Dominion Bank", "TD Bank Group",
    "TD", "TDB", "TD-Bank", "T-D", "T.D.", "T D Bank", "T.D. Bank",
    "TD Banknorth", "TD Waterhouse", "TD Securities",
    "TD Canada Trust", "TD Ameritrade", "TD Auto Finance", "TD Wealth Management",
    "TD Direct Investing", "TD Insurance", "TD Commercial Banking", "TD Private Banking",
    "TD Asset Management", "TD Securities", "TD Investment Services",
    "TD Cash Credit Card", "TD Cash Back Credit Card", "TD Double Up Credit Card",
    "TD First Class Travel Visa", "TD Aeroplan Visa", "TD Business Cash Back Visa",
    "TD Business Travel Visa", "TD Student Credit Card", "TD Secured Credit Card",
    "TD Rewards Credit Card", "TD Platinum Travel Visa", "TD Gold Elite Visa",
    "TD Convenience Checking", "TD Beyond Checking", "TD Premier Checking",
    "TD Student Checking", "TD 60+ Checking", "TD Business Checking",
    "TD Simple Business Checking", "TD Commercial Checking",
    "TD Simple Savings", "TD Growth Money Market", "TD Special Rate CD",
    "TD Choice Promotional CD", "TD Signature Select", "TD IRA",
    "TD Traditional IRA", "TD Roth IRA", "TD SEP IRA", "TD Simple IRA",
    "TD Mortgage", "TD Home Equity", "TD Personal Loan", "TD Student Loan",
    "TD Auto Loan", "TD Business Loan", "TD Line of Credit", "TD HELOC",
    "TD Fixed Rate Mortgage", "TD Adjustable Rate Mortgage", "TD Jumbo Mortgage",
    "TD EasyWeb", "TD Mobile App", "TD Online Banking", "TD Digital Banking",
    "TD Mobile Deposit", "TD Zelle", "TD Bill Pay", "TD MySpend",
    "TD GoalAssist", "TD Clari", "TD Mobile Banking",
    "TD Customer Service", "TD Branch", "TD ATM", "TD Teller", "TD Call Center",
    "TD Customer Care", "TD Support", "TD Help Desk", "TD Phone Banking",
    "TD checking", "TD savings", "TD credit", "TD debit", "TD card",
    "TD account", "TD online", "TD app", "TD mortgage", "TD loan",
    "td bank", "td", "td checking", "td savings", "td credit card",
    "td online banking", "td mobile app", "td customer service",
    "TD Bankz", "T D Bank", "TD Can Trust", "TD Ameritrd", "TD Amertrade",
    "Toronto Dom", "Toronto-Dom", "TD Banc", "TDBank", "TD_Bank",
    "TD Green", "TD Canada", "TD US", "TD USA", "TD American",
    "TD North", "TD East Coast", "TD New England", "TD Northeast",
    "TD Business Banking", "TD Commercial", "TD Corporate Banking",
    "TD Treasury Services", "TD Merchant Services", "TD Business Credit Card",
    "TD Commercial Real Estate", "TD Equipment Finance",
    "TD Wealth", "TD Investment", "TD Portfolio", "TD Financial Planning",
    "TD Private Investment Counsel", "TD Asset Management USA",
    "TD Epoch", "TD Greystone", "TDAM",
    "Commerce Bank", "TD Commerce", "Banknorth", "TD Banknorth Group",
)
MENTION_TERMS = {"td_bank": TD_BANK_TERMS}

TREND_CATEGORIES = ("savings account", "checking account", "credit card", "mortgage rates")
TREND_COMBINATIONS = (
    "savings account", "checking account", "credit card", "mortgage rates",
    "personal loan", "business banking", "investment advisor", "wealth management",
)


@dataclass(frozen=True)
class MentionSettings:
    """Scoring of brand mentions; ``strict_length`` terms need word edges."""

    strict_length: int = 3
    edge_confidence: float = 1.0
    inner_confidence: float = 0.7
    diversity_weight: float = 0.4
    quality_weight: float = 0.4
    length_weight: float = 0.2
    diversity_full: int = 3
    length_full: int = 10
    min_chars: int = 2
    accept_above: float = 0.3
    context_chars: int = 20


@dataclass(frozen=True)
class IngestWindow:
    overlap_seconds: int = 2 * 3600
    initial_days: int = 7


@dataclass(frozen=True)
class DateRange:
    """Inclusive bounds; either may be open."""

    start: str | None = None
    end: str | None = None


DEFAULT_MENTION = MentionSettings()
DEFAULT_ENRICH = EnrichSettings()
DEFAULT_FEATURES = FeatureSettings()
DEFAULT_DAILY = DailySettings()
DEFAULT_SCORE = ScoreSettings()
DEFAULT_WEIGHTS = Weights()
DEFAULT_BM25 = Bm25()
