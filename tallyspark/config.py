"""Pipeline configuration as plain data.

Config objects are passed into every stage; nothing reads module globals at
run time.  The small dimensions (bank profiles, value map, taxonomy) have a
size fixed by the configuration, never by the data, so they can be embedded
in expressions or broadcast without a size check.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BankProfile:
    bank: str            # name searched in the lower-cased file name
    skip_rows: int       # preamble lines before the header line
    split_class: str     # characters that separate tokens of `particulars`


@dataclass(frozen=True)
class Taxonomy:
    """Ordered (category, [sub-category labels]) pairs; order breaks ties."""
    groups: tuple[tuple[str, tuple[str, ...]], ...]

    def entries(self) -> list[tuple[int, str, str]]:
        """(ord, category, label) in declaration order, 0-based ord."""
        out = []
        for cat, labels in self.groups:
            for lab in labels:
                out.append((len(out), cat, lab))
        return out


# These must equal the original pipeline's behaviour.
HEADER_RULES = (("date", "date"), ("narration", "particulars"),
                ("withdrawal amt.", "dr"), ("deposit amt.", "cr"))
NULL_THRESHOLD = 2
MAX_FILES = 2
FUZZY_THRESHOLD = 80
MANUAL_LABEL = "MANUAL"
UNSPECIFIED_LABEL = "Unspecified"
NULL_CATEGORY = "unspecified"
KEY_COLUMNS = ("date", "particulars", "dr", "cr")
MIN_TXN_ID_LEN = 5
INVALID_TXN_IDS = ("FOR", "TO", "BY", "ON", "AT", "THE", "AND", "FROM", "VIA")
FILTER_APP_KEPT = ("Income", "Investment", "Debt Clearance")
FILTER_APP_BLANK = ("Transfer",)
FILTER_APP_OTHER = "Expense"


@dataclass(frozen=True)
class Settings:
    banks: tuple[BankProfile, ...]
    value_map: tuple[tuple[str, str], ...]
    taxonomy: Taxonomy
    generic_categories: tuple[str, ...]
    salary_account: str
    salary_label: str = "Salary"
    manual_label: str = MANUAL_LABEL
    unspecified_label: str = UNSPECIFIED_LABEL
    null_category: str = NULL_CATEGORY
    null_payee: str = "none"
    fuzzy_threshold: int = FUZZY_THRESHOLD
    case_sensitive: bool = False
    normalize_map_keys: bool = False
    null_threshold: int = NULL_THRESHOLD
    max_files: int = MAX_FILES
    # header substring rules, applied in order, first hit renames the column
    header_rules: tuple[tuple[str, str], ...] = HEADER_RULES
    # bytes of the value -> label lookup above which it is joined by shuffle
    # instead of broadcast
    max_broadcast_bytes: int = 32 << 20
    # Files of a month table above which small ones are written anew
    max_month_files: int = 64
    # Only these files of the inbox are statements
    file_glob: str = "*.{csv,txt,CSV,TXT}"
    key_columns: tuple[str, ...] = KEY_COLUMNS
    min_txn_id_len: int = MIN_TXN_ID_LEN
    invalid_txn_ids: tuple[str, ...] = INVALID_TXN_IDS
    filter_app_kept: tuple[str, ...] = FILTER_APP_KEPT
    filter_app_blank: tuple[str, ...] = FILTER_APP_BLANK
    filter_app_other: str = FILTER_APP_OTHER

    def bank(self, name: str) -> BankProfile:
        for b in self.banks:
            if b.bank == name:
                return b
        raise KeyError(name)


# The two statement layouts the pipeline understands.
# axis: 17 preamble lines, tokens split on "/"; hdfc: 20 preamble lines,
# tokens split on "-" or space.
BANKS = (
    BankProfile("axis", 17, "/"),
    BankProfile("hdfc", 20, "- "),
)

# Our own value map: whole raw values (after lower-casing) -> standard value.
# Two keys carry capitals on purpose; like the original behaviour they never
# match because the value is lower-cased first (normalize_map_keys=False).
VALUE_MAP = (
    ("swigy", "Swiggy"),
    ("zomto", "Zomato"),
    ("petrol", "Fuel"),
    ("diesel", "Fuel"),
    ("cab", "Taxi"),
    ("uber", "Taxi"),
    ("ola", "Taxi"),
    ("veggies", "Vegetables"),
    ("milk", "Dairy"),
    ("chai", "Tea"),
    ("coffee", "Cafe"),
    ("med", "Pharmacy"),
    ("bday", "Gifts"),
    ("wifi", "Internet"),
    ("sal", "Salary"),
    ("mf", "SIP"),
    ("clothing", "Clothes"),
    ("Netflix", "Movies"),
    ("Jio", "Mobile"),
)

# Our own taxonomy.  "Books" sits under two parents (the later one wins),
# "FD"/"RD" are two-letter labels found inside longer words, "Rent" and "Taxi"
# have equal length, "Movies" and "Interest" are reached by fuzzy matching in
# the synthetic data.
TAXONOMY = Taxonomy((
    ("Housing", ("Rent", "Furniture", "Repairs", "Home Decor")),
    ("Utilities", ("Electricity", "Water", "Internet", "Mobile", "Gas")),
    ("Groceries", ("Grocery", "Vegetables", "Fruits", "Dairy", "Meat")),
    ("Dining", ("Restaurants", "Cafe", "Swiggy", "Zomato", "Snacks", "Tea")),
    ("Transport", ("Fuel", "Taxi", "Train", "Metro", "Parking")),
    ("Health", ("Pharmacy", "Doctor", "Insurance", "Gym")),
    ("Family", ("Kids", "Wife", "School", "Gifts")),
    ("Leisure", ("Movies", "Music", "Travel", "Books")),
    ("Education", ("Books", "Courses", "Tuition")),
    ("Investment", ("SIP", "FD", "RD", "Stocks")),
    ("Income", ("Salary", "Interest", "Dividend", "Cashback")),
    ("Debt Clearance", ("EMI", "Credit Card")),
    ("Transfer", ("Transfer", "Refund", "Self")),
    ("Shopping", ("Clothes", "Electronics", "Amazon", "Flipkart")),
    ("Personal", ("Salon", "Laundry", "Donation")),
))

# Our own list of generic category tokens that defer to the payee.
GENERIC_CATEGORIES = ("upi", "payment", "pay to", "transfer to", "mandate",
                      "recurring", "collect", "misc")

DEFAULT = Settings(
    banks=BANKS,
    value_map=VALUE_MAP,
    taxonomy=TAXONOMY,
    generic_categories=GENERIC_CATEGORIES,
    salary_account="77001234",
)
