"""Names, formats and rates that input files and existing tables already use.

Fixed values: they have to stay as they are for results to agree with data
that is already out there.
"""

# Raw file kinds; a drop holds files named <kind>_*.csv.
SALES_KIND = "sales_transactions_SS_raw"
AGENTS_KIND = "sales_agents_SS_raw"
BRANCHES_KIND = "branches_SS_raw"

# Hour folder below the raw base, and the layout of one drop inside it.
HOUR_FOLDER_FORMAT = "%Y/%m/%d/%H"

# Columns of the raw files, in file order (two headers are misspelt at the source).
SALES_COLUMNS = (
    "transaction_id",
    "transaction_date",
    "customer_id",
    "customer_fname",
    "cusomter_lname",
    "cusomter_email",
    "sales_agent_id",
    "branch_id",
    "product_id",
    "product_name",
    "product_category",
    "offer_1",
    "offer_2",
    "offer_3",
    "offer_4",
    "offer_5",
    "units",
    "unit_price",
    "is_online",
    "payment_method",
    "shipping_address",
)
AGENT_COLUMNS = ("sales_person_id", "name")
BRANCH_COLUMNS = ("branch_id", "class", "location")

# Misspelt header -> column name.
SALES_RENAMES = {"cusomter_lname": "customer_lname", "cusomter_email": "customer_email"}

# Offer column -> discount in percent; the first offer that is set wins.
OFFER_DISCOUNTS = {"offer_1": 5, "offer_2": 10, "offer_3": 15, "offer_4": 20, "offer_5": 25}
NO_DISCOUNT = 0

# Everything behind the first ".com" of an email is junk.
EMAIL_TAIL_PATTERN = r"(\.com).*"
EMAIL_TAIL = ".com"

# A shipping address is address/city/state/postal_code.
ADDRESS_SEPARATOR = "/"
ADDRESS_PARTS = ("address", "city", "state", "postal_code")

# Words of the is_online column.
ONLINE_WORD = "yes"
OFFLINE_WORD = "no"

# Warehouse tables.
FACT_TABLE = "sales_transactions_fact"
CUSTOMER_TABLE = "customer_dim"
PRODUCT_TABLE = "product_dim"
AGENT_TABLE = "sales_agent_dim"
BRANCH_TABLE = "branch_dim"

# Daily report: it looks at the day this many days back.
REPORT_DAYS_BACK = 905

# App events that carry money.
PURCHASE_EVENT = "purchase"
