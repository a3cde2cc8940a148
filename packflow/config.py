"""Fixed values of the model.

These constants must equal the reference's for equal results; they are stated
here once, in natural order, and turned into small lookup DataFrames / CASE
expressions by the operators.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: pack configurations per velocity class -------------------
# class, label, description, multiplier, unit, cost factor
PACK_CONFIGS = [
    ("fast_mover", "Bulk Logistics Case",
     "High-volume bulk case pack for continuous replenishment", 24, "case", 0.85),
    ("medium_mover", "Standard Consumer Pack",
     "Standard shelf-ready pack for regular distribution", 12, "pack", 1.00),
    ("slow_mover", "Promotional Multipack",
     "Promotional bundle to accelerate slow-moving inventory", 6, "multipack", 1.10),
]
VELOCITY_CLASSES = ["fast_mover", "medium_mover", "slow_mover"]
DEFAULT_CLASS = "medium_mover"

# ---- fixed values: per-class rates ------------------------------------------
# estimated inventory reduction % by class, otherwise 20
INVENTORY_REDUCTION_PCT = {"fast_mover": 30.0, "medium_mover": 23.0, "slow_mover": 15.0}
INVENTORY_REDUCTION_DEFAULT = 20.0
# revenue uplift factor: fast 1.12, medium 1.08, anything else 1.05
REVENUE_UPLIFT = {"fast_mover": 1.12, "medium_mover": 1.08}
REVENUE_UPLIFT_ELSE = 1.05
# COGS factor: fast 0.96, medium 0.97, anything else 0.98
COGS_FACTOR = {"fast_mover": 0.96, "medium_mover": 0.97}
COGS_FACTOR_ELSE = 0.98
# debtor-day improvement: fast 0.30, medium 0.27, slow 0.25, missing 0.27
DEBTOR_IMPROVEMENT = {"fast_mover": 0.30, "medium_mover": 0.27, "slow_mover": 0.25}
DEBTOR_IMPROVEMENT_DEFAULT = 0.27

# ---- fixed values: finance ------------------------------------------------------
DAYS_PER_YEAR = 365
COGS_RATIO = 0.60
OVERHEAD_RATIO = 0.15
OVERHEAD_AFTER_FACTOR = 0.97
CARRYING_COST_RATE = 0.22
DEBTOR_DAYS_BEFORE = 45
FINANCING_RATE = 0.06
INVENTORY_COVER_DAYS = 30

# ---- fixed values: KPI target ranges (metric, min, max) -------------------------
KPI_RANGES = [
    ("PBT Uplift %", 10.0, 18.0),
    ("Revenue Uplift %", 8.0, 15.0),
    ("Inventory Reduction %", 20.0, 30.0),
    ("Lead Time Reduction %", 20.0, 30.0),
    ("Debtor Improvement %", 25.0, 35.0),
]

# ---- fixed values: production ------------------------------------------------------
TARGET_UTILISATION = 0.82
MAX_UTILISATION = 0.95
ISSUE_RATE_THRESHOLD = 0.08
CAPACITY_HEADROOM = 1.10
DEMAND_SAFETY = 1.05
EOQ_SETUP_COST = 500.0
EOQ_HOLDING_RATE = 0.22
EOQ_MIN_BATCH = 50
EOQ_FALLBACK = 100
LEAD_TIME_FALLBACK = 14
LEAD_TIME_MIN, LEAD_TIME_MAX = 1, 30

# ---- fixed values: right-closed bins (0,100], (100,500], (500,inf) ---------------
BIN_EDGES = (0.0, 100.0, 500.0)
SCHEDULE_LABELS = ("Low", "Medium", "High")
DISPATCH_LABELS = ("Standard", "Priority", "Express")

# ---- fixed values: dispatch lead times -----------------------------------------------
LEAD_TIME_SLOWEST = 15.0
LEAD_TIME_SPAN = 10.0
LEAD_TIME_FASTEST = 5.0
REDUCTION_AT_FASTEST = 29.0
REDUCTION_SPAN = 8.0

# ---- fixed values: downgrade of unprofitable SKUs -------------------------------------
DOWNGRADE_CLASS = "slow_mover"
DOWNGRADE_SCORE_FACTOR = 0.7

EPS = 1e-9


@dataclass(frozen=True)
class ForecastConfig:
    horizon_days: int = 30
    num_trees: int = 100
    max_depth: int = 8
    seed: int = 42
    train_fraction: float = 0.8
    split_mode: str = "cutoff_date"    # "sku_date_order" | "per_sku_tail" | "cutoff_date"
    method: str = "forest"             # "forest" | "naive"


@dataclass(frozen=True)
class ClusterConfig:
    k: int = 3
    seed: int = 42
    restarts: int = 10
    max_iter: int = 50
    parallelism: int = 10
