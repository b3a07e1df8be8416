"""Parameters of the models and the fixed lookups they use."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    """Thresholds and rates. Fractions compared with exact sums are Decimal."""

    # ABC: upper bound of cumulative revenue for class A and class B
    abc_a: Decimal = Decimal("0.80")
    abc_b: Decimal = Decimal("0.95")
    # XYZ: highest coefficient of variation for class X and class Y
    xyz_x: float = 0.50
    xyz_y: float = 1.00
    min_observations: int = 4
    cv_unknown: float = 9.99
    # safety stock
    service_z: float = 1.65
    lead_sigma_floor: float = 0.5
    lead_mean_fallback: float = 4.0
    lead_sigma_fallback: float = 1.0
    # inventory health
    overstock_multiple: float = 2.2
    excess_multiple: int = 2
    holding_cost_rate: Decimal = Decimal("0.20")
    stock_low: float = 0.4
    stock_span: float = 2.1
    # loss audit: share of negative lines, in percent, above which a product is listed
    loss_line_pct: int = 25
    # smallest promise, in days, after cleaning
    min_scheduled_days: int = 1
    # report bands
    otif_target: float = 95.0
    otif_green: float = 90.0
    route_otif_alarm: float = 60.0
    month_otif_alarm: float = 50.0
    heat_low: float = 50.0
    heat_mid: float = 80.0
    heat_delay: float = 0.50


DEFAULTS = Params()

# Priority, risk level, strategy, policy and grid label of each segment.
SEGMENT_STRATEGY = [
    ("AX", "HIGH", "LOW", "Automate Replenishment (JIT)",
     "High-value stable demand. Implement automated continuous review (s, Q), optimize batch sizes, establish Vendor Managed Inventory (VMI).",
     "AX: JIT Replenish"),
    ("AY", "HIGH", "MEDIUM", "Close Monitoring & Seasonal Buffer",
     "High-value seasonal or shifting demand. Implement dynamic safety stock, bi-weekly S&OP review, and responsive replenishment agreements.",
     "AY: Seasonal Buffer"),
    ("AZ", "CRITICAL RISK", "HIGH", "Active Management / Make-to-Order",
     "High-value erratic demand. Substantial capital at risk. Keep lean base stock with agile supplier lead times, or adopt make-to-order where feasible.",
     "AZ: CRITICAL RISK BUFFER"),
    ("BX", "MEDIUM", "LOW", "Standard Periodic Replenishment",
     "Moderate-value stable demand. Automated monthly reorder points, economic order quantity (EOQ) optimization.",
     "BX: Automated Reorder"),
    ("BY", "MEDIUM", "MEDIUM", "Periodic S&OP Review",
     "Moderate-value variable demand. Monthly buffer reviews, track promotional spikes and lead-time variability.",
     "BY: Periodic Review"),
    ("BZ", "MEDIUM-HIGH RISK", "HIGH", "Inventory Rationalization",
     "Moderate-value erratic demand. Limit batch quantities, evaluate vendor MOQ, maintain conservative safety stock.",
     "BZ: Rationalize MOQ"),
    ("CX", "LOW", "LOW", "Bulk Order / High MOQ",
     "Low-value stable demand. Infrequent bulk ordering to minimize handling and ordering transactions.",
     "CX: Bulk Order"),
    ("CY", "LOW", "LOW-MEDIUM", "Standard Reorder Tolerances",
     "Low-value variable demand. Wide safety tolerances, low management touchpoint.",
     "CY: Standard Tol."),
    ("CZ", "PURGE / MONITOR", "HIGH (OBSOLESCENCE)", "Obsolescence Review / Rationalize",
     "Low-value erratic demand. High likelihood of stock obsolescence and trapped working capital. Evaluate SKU rationalization, purge or markdown.",
     "CZ: PURGE CANDIDATE"),
]

# Stock status labels.
REORDER = "REORDER IMMEDIATELY"
OVERSTOCKED = "OVERSTOCKED"
OPTIMAL = "OPTIMAL"

# Directive texts; the deficit is put between head and tail.
DEFICIT_HEAD = "⚠️ CRITICAL DEFICIT: Reorder Immediately ("
DEFICIT_TAIL = " units below safety threshold)"
OVERSTOCK_TEXT = "📦 OVERSTOCKED: Inventory exceeds 220% of ROP (Liquidate / Reduce MOQ)"
OPTIMAL_TEXT = "✅ OPTIMAL: On-hand stock is within operational S&OP band"

# Labels of the total rows.
ROUTE_TOTAL = "TOTAL / ENTERPRISE AVERAGE"
MONTH_TOTAL = "FULL PERIOD TOTAL / AVG"
ROSTER_TOTAL = "TOTAL PORTFOLIO ALLOCATION"
