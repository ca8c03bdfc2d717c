"""Offer and lift dimensions. They are data: a few fixed rows, joined by broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OFFER_SCHEMA = (
    "segment string, risk string, action string, offer string, channel string, timing string"
)
LIFT_SCHEMA = "segment string, risk string, lift double"
ARCHETYPE_SCHEMA = (
    "segment_name string, description string, strategy string, channel string, offer string, "
    "urgency string"
)

# The three offer libraries, `segment: risk: (action, offer, channel, timing[, cost])`.
PROGRAMME_OFFERS = {
    "Seasonal Travelers": {
        "High": ("Off-Season Reactivation", "4,000 bonus miles + exclusive off-peak fare (30% off)",
                 "Email + SMS simultaneously", "Within 72 hours", 40),
        "Medium": ("Seasonal Re-Engagement", "Upcoming season preview + 2,000 bonus miles",
                   "Email", "Within 14 days", 20),
        "Low": ("Seasonal Newsletter", "Seasonal deals + destination inspiration",
                "Email", "Monthly", 5),
    },
    "Active Champions": {
        "High": ("Loyalty Lock-In", "6,000 bonus miles + priority check-in for 6 months",
                 "Email + App push", "Within 3 days", 70),
        "Medium": ("Engagement Boost", "Double miles on next 3 flights",
                   "Email", "Within 14 days", 30),
        "Low": ("Loyalty Appreciation", "1,500 bonus miles as thank-you",
                "Email", "Quarterly", 15),
    },
    "Premium Loyalists": {
        "High": ("VIP Retention Call", "Complimentary companion ticket + status guarantee 12 months",
                 "Personal phone call + premium email", "Within 24 hours", 200),
        "Medium": ("Loyalty Appreciation", "10,000 bonus miles + lounge access upgrade (3 visits)",
                   "Email", "Within 3 days", 100),
        "Low": ("Tier Thank-You", "3,000 bonus miles as loyalty recognition",
                "Email", "Monthly", 30),
    },
    "Miles Hoarders": {
        "High": ("Redemption Activation", "2× redemption value + 60-day flash sale on points",
                 "Email + App push", "Within 72 hours", 50),
        "Medium": ("Redemption Reminder", "50% bonus on any redemption within 60 days",
                   "Email", "Within 10 days", 30),
        "Low": ("Points Expiry Warning", "Balance statement + expiry alert + 500 bonus miles",
                "Email", "Monthly", 5),
    },
    "Engaged Regulars": {
        "High": ("Urgent Retention Offer", "5,000 bonus miles + waived change fees for 60 days",
                 "SMS + Email", "Within 48 hours", 55),
        "Medium": ("Engagement Campaign", "3,000 bonus miles on next flight",
                   "Email", "Within 7 days", 30),
        "Low": ("Loyalty Touch", "1,000 bonus miles", "Email", "Quarterly", 10),
    },
}

STAGED_OFFERS = {
    "Premium Loyalists": {
        "low": ("Monitor + VIP newsletter", "Early access to new routes", "App notification", "Monthly"),
        "medium": ("Tier extension", "Tier status extended 6 months + 5K bonus miles",
                   "Personalized email", "Within 14 days"),
        "high": ("Executive intervention", "Tier extended 12m + 15K miles + lounge upgrade",
                 "Personal call + email", "Within 48 hours"),
    },
    "Silent Drifters": {
        "low": ("Gentle re-engagement", "We miss you — 2K bonus miles on next booking",
                "Email", "Within 21 days"),
        "medium": ("Win-back campaign", "5K bonus miles + tier extension 3 months",
                   "Email + SMS", "Within 7 days"),
        "high": ("Urgent reactivation", "8K bonus miles + waived change fees for 60 days",
                 "SMS + Email + App push", "Within 48 hours"),
    },
    "Miles Hoarders": {
        "low": ("Redemption nudge", "Reminder: your miles expire in 12 months",
                "Email", "Within 30 days"),
        "medium": ("Redemption incentive", "Use 10K miles, earn 2K bonus — this month only",
                   "Email + App", "Within 14 days"),
        "high": ("Urgent redemption push", "Triple bonus on next redemption + flight discount",
                 "Email + SMS", "Within 5 days"),
    },
    "Seasonal Travelers": {
        "low": ("Seasonal campaign", "Holiday travel deals + 3K bonus miles",
                "Email", "4 weeks before peak season"),
        "medium": ("Seasonal activation", "Exclusive vacation bundle + bonus miles",
                   "Email + App", "3 weeks before peak season"),
        "high": ("Priority seasonal offer", "Personalised itinerary + 6K miles + seat upgrade",
                 "Email + Personal outreach", "2 weeks before peak season"),
    },
    "Rising Stars": {
        "low": ("Nurture campaign", "Tier upgrade progress tracker + 2K miles accelerator",
                "App + Email", "Monthly"),
        "medium": ("Tier challenge", "Fly 3 more times this quarter → unlock Silver status",
                   "App push + Email", "Within 14 days"),
        "high": ("Accelerated loyalty push", "Double miles for next 60 days + tier fast-track",
                 "Email + SMS", "Within 7 days"),
    },
    "Budget Frequent Flyers": {
        "low": ("Value reinforcement", "Co-branded card offer — earn miles on daily spend",
                "Email", "Within 30 days"),
        "medium": ("Partner bundle", "Hotel + car + miles package — save 20%",
                   "Email + App", "Within 14 days"),
        "high": ("Competitive retention", "Price-match guarantee + 4K miles on next booking",
                 "Email + SMS", "Within 5 days"),
    },
    "At-Risk VIPs": {
        "low": ("VIP re-engagement", "Complimentary lounge access for 3 visits",
                "Personal email from account manager", "Within 14 days"),
        "medium": ("High-value intervention", "Tier extension 12m + 10K miles + priority support",
                   "Phone call + email", "Within 5 days"),
        "high": ("CRITICAL — Maximum retention", "Tier extension 18m + 20K miles + dedicated concierge",
                 "CEO/Director personal call + email", "Within 24 hours"),
    },
    "DEFAULT": {
        "low": ("Standard monitoring", "Quarterly engagement email", "Email", "Quarterly"),
        "medium": ("Standard re-engagement", "3K bonus miles on next booking",
                   "Email", "Within 14 days"),
        "high": ("Urgent retention", "5K bonus miles + tier extension 3 months",
                 "Email + SMS", "Within 7 days"),
    },
}

MODULE_OFFERS = {
    "Premium Loyalists": STAGED_OFFERS["Premium Loyalists"],
    "Silent Drifters": STAGED_OFFERS["Silent Drifters"],
    "Miles Hoarders": {
        "low": ("Redemption nudge", "Use 5K miles this month, earn 1K bonus", "Email", "Within 30 days"),
        "medium": ("Redemption campaign", '"Double value" miles redemption event for 2 weeks',
                   "Email + App", "Within 14 days"),
        "high": ("Expiry warning + rescue offer", "Miles expiring soon + 10K bonus for first redemption",
                 "Email + SMS", "Within 7 days"),
    },
    "Seasonal Travelers": {
        "low": ("Seasonal newsletter", "Coming-season destination highlights",
                "Email", "4 weeks before peak season"),
        "medium": ("Seasonal pre-booking offer", "Book now, earn 3X miles on summer flights",
                   "Email + App", "6 weeks before peak season"),
        "high": ("Targeted seasonal win-back", "Exclusive package: flight + hotel + 8K bonus miles",
                 "Email + SMS", "Immediately"),
    },
    "Rising Stars": {
        "low": ("Tier progress nudge", "You are X miles from Silver status!", "App push", "Monthly"),
        "medium": ("Tier challenge", "Complete 3 flights in 60 days, earn Silver status",
                   "Email + App", "Within 14 days"),
        "high": ("Accelerator offer", "Double miles on all flights this month",
                 "Email + SMS + App", "Within 7 days"),
    },
    "Budget Frequent Flyers": {
        "low": ("Partner promotion", "Earn 2X miles with hotel partner this month", "Email", "Monthly"),
        "medium": ("Value bundle", "Discounted upgrade + bonus miles combo",
                   "Email + App", "Within 14 days"),
        "high": ("Loyalty lock-in", "Co-branded card offer: 10K signup bonus miles",
                 "Email + Direct mail", "Within 7 days"),
    },
    "At-Risk VIPs": {
        "low": ("VIP check-in", "Complimentary lounge visit invitation",
                "Personal email", "Within 21 days"),
        "medium": ("VIP rescue", "Tier extension + 10K miles + premium lounge access",
                   "Personal call + email", "Within 7 days"),
        "high": ("Executive outreach", "Dedicated account manager + 20K miles + tier guarantee",
                 "Phone + Personal email", "Within 24 hours"),
    },
}

# Expected lift per segment (low, medium, high).
LIFT = {
    "Premium Loyalists": (0.05, 0.30, 0.48),
    "Silent Drifters": (0.15, 0.35, 0.28),
    "Miles Hoarders": (0.12, 0.28, 0.22),
    "Seasonal Travelers": (0.10, 0.25, 0.20),
    "Rising Stars": (0.08, 0.32, 0.25),
    "Budget Frequent Flyers": (0.08, 0.20, 0.18),
    "At-Risk VIPs": (0.35, 0.45, 0.40),
}
DEFAULT_LIFT = {"low": 0.10, "medium": 0.22, "high": 0.30}
RISK_LIFT = {"low": 0.08, "medium": 0.18, "high": 0.28}
RISK_LEVELS = ("low", "medium", "high")

# Segment archetypes (description, strategy, channel, offer, urgency).
ARCHETYPES = {
    "Premium Loyalists": (
        "High CLV, stable engagement, consistent flyers",
        "VIP treatment, exclusive benefits, personal relationship manager",
        "Personal outreach + Premium app features",
        "Lounge access, priority boarding, milestone rewards", "Low — maintain relationship"),
    "Silent Drifters": (
        "Declining engagement, once-active customers going quiet",
        "Urgent re-engagement — act within 30 days", "Email + SMS + In-app push",
        "5,000 bonus miles for next booking + tier extension", "HIGH — imminent churn risk"),
    "Miles Hoarders": (
        "High points balance, low redemption — emotionally detached",
        "Redemption incentives to re-engage with the program", "Email campaign",
        '"Use 10K miles, earn 2K bonus" limited-time offer', "Medium — engage before balance lapses"),
    "Seasonal Travelers": (
        "Periodic activity peaks (holiday / vacation flyers)",
        "Targeted campaigns before their typical travel window",
        "Email 4 weeks before peak season", "Vacation bundle + bonus miles on leisure bookings",
        "Low-Medium — seasonal activation"),
    "Rising Stars": (
        "Growing engagement, increasing flight frequency",
        "Nurture to next tier — show path to elite status", "App + Email",
        "Tier upgrade challenge + bonus mile accelerator", "Low — accelerate growth trajectory"),
    "Budget Frequent Flyers": (
        "High frequency but low CLV — price-sensitive travelers",
        "Volume rewards + partner benefits to increase spend", "Email + App",
        "Co-branded card offer, hotel / car partner promotions",
        "Medium — risk of switching to cheaper competitor"),
    "At-Risk VIPs": (
        "Previously high-value customers showing sharp decline",
        "Maximum intervention — executive outreach justified",
        "Personal call + priority email + lounge invitation",
        "Tier retention + 20K miles + dedicated account manager",
        "CRITICAL — losing these customers is most costly"),
}
# Where the staged scripts' archetypes differ.
STAGED_ARCHETYPES = ARCHETYPES | {
    "Seasonal Travelers": (
        "Periodic activity peaks (holiday/vacation flyers)",
        "Targeted campaigns before their typical travel window",
        "Email 4 weeks before peak season", "Vacation bundle + bonus miles on leisure bookings",
        "Low-Medium — seasonal activation"),
    "Budget Frequent Flyers": (
        "High frequency but low CLV — price-sensitive travelers",
        "Volume rewards + partner benefits to increase spend", "Email + App",
        "Co-branded card offer, hotel/car partner promotions",
        "Medium — risk of switching to cheaper competitor"),
    "At-Risk VIPs": (
        "Previously high-value customers showing sharp decline",
        "Maximum intervention — executive outreach justified",
        "Personal call + Email + Premium offer",
        "Tier extension 12 months + 15K bonus miles + lounge pass",
        "CRITICAL — high revenue at risk"),
}
DEFAULT_ARCHETYPE = {
    "strategy": "Standard engagement", "offer": "Generic offer", "urgency": "Low", "channel": "Email",
}


def offer_rows(library: dict) -> list[tuple]:
    return [(segment, risk, *offer) for segment, levels in library.items() for risk, offer in levels.items()]


def lift_rows() -> list[tuple]:
    return [(s, risk, lift) for s, lifts in LIFT.items() for risk, lift in zip(RISK_LEVELS, lifts)]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Fixed rows as a literal relation: nothing is shipped from Python at run time."""
    columns = [c.split() for c in schema.split(", ")]
    names = ", ".join(name for name, _ in columns)
    typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({names})")


def programme_offers(spark: SparkSession) -> DataFrame:
    return literal_table(spark, offer_rows(PROGRAMME_OFFERS), OFFER_SCHEMA + ", incentive_cost int")


def staged_offers(spark: SparkSession) -> DataFrame:
    return literal_table(spark, offer_rows(STAGED_OFFERS), OFFER_SCHEMA)


def module_offers(spark: SparkSession) -> DataFrame:
    return literal_table(spark, offer_rows(MODULE_OFFERS), OFFER_SCHEMA)


def lift_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, lift_rows(), LIFT_SCHEMA)


def archetypes(spark: SparkSession, staged: bool = False) -> DataFrame:
    table = STAGED_ARCHETYPES if staged else ARCHETYPES
    return literal_table(spark, [(n, *a) for n, a in table.items()], ARCHETYPE_SCHEMA)
