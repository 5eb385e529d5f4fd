"""Names, formats and limits that stored data depends on."""

# The code-metric features, in file order.
FEATURES = [
    "wmc", "dit", "noc", "cbo", "rfc", "lcom", "ca", "ce", "npm", "lcom3",
    "loc", "dam", "moa", "mfa", "cam", "ic", "cbm", "amc", "max_cc", "avg_cc",
]

# Ticket file header -> column name.
TICKET_COLUMNS = {
    "Issue key": "issue_key",
    "Issue Type": "issue_type",
    "Status": "status",
    "Project key": "project_key",
    "Project name": "project_name",
    "Project type": "project_type",
    "Resolution": "resolution",
    "Created": "created_str",
    "Resolved": "resolved_str",
}

# Text format of the ticket dates.
TICKET_DATE_FORMAT = "dd/MM/yyyy HH:mm"

# Version suffix of a code-metric file name.
VERSION_PATTERN = r"-([0-9][0-9.a-z]*)\.csv$"

# Score limits and labels of the priority tiers, highest first.
TIERS = [
    (50.0, "[P0] CRITICAL"),
    (30.0, "[P1] HIGH"),
    (20.0, "[P2] MEDIUM"),
]
LOWEST_TIER = "[P3] LOW"

# Percent limits of the two-cut rate bands, highest first.
RATE_BANDS = [(50.0, "high"), (30.0, "medium")]
LOWEST_BAND = "low"

# Years reported by the yearly throughput table.
YEAR_RANGE = (2010, 2024)

# Sizes of the ranked reports.
TOP_MODULES = 25
TOP_SYSTEMS = 20
MIN_GROUP = 100

# Seed, train share and folds of model training.
SEED = 42
TRAIN_SHARE = 0.8
FOLDS = 5
