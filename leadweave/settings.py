"""Run settings with their default values (all overridable)."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: default settings -----------------------------------------
STATE_LISTS = {
    "south_central": ["TX", "LA", "AR", "OK"],
    "southeast": ["FL", "GA", "NC", "SC", "TN", "AL", "MS"],
    "northeast": ["NJ", "NY", "PA", "CT", "MA", "MD", "VA"],
    "midwest": ["OH", "IL", "IN", "MI", "WI", "MN", "MO", "IA"],
    "west": ["CA", "WA", "OR", "AZ", "CO", "NV", "UT"],
}
DEFAULT_STATE_LIST = "south_central"
VERTICAL_KEYWORDS = {
    "fragrance": ["fragrance manufacturer", "candle manufacturer"],
    "flavor": ["flavor manufacturer", "seasoning manufacturer"],
    "food": ["food manufacturer", "food processor"],
    "pharma": ["pharmaceutical manufacturer", "CDMO"],
    "nutraceutical": ["supplement manufacturer", "nutraceutical manufacturer"],
}
SIGNAL_TERMS = ["Walmart SQEP supplier", "Walmart OTIF fine supplier"]
IMPORT_KEYWORDS = {
    "fragrance": ["fragrance compound"],
    "flavor": ["flavor extract"],
    "food": ["food ingredient"],
    "pharma": ["pharmaceutical ingredient"],
    "nutraceutical": ["dietary supplement ingredient"],
}
CHANNEL_POINTS = {1: 5, 2: 15, 3: 25, 4: 35}
SIGNAL_POINTS = {"walmart_supplier": 10, "sqep_mentioned": 10, "otif_mentioned": 10, "compliance_pain": 10}
STATE_POINTS = {"in_target_state": 15, "other": 0}
CONTACT_POINTS = {
    "email_and_logistics_title": 15,
    "email": 10,
    "pattern": 5,
    "name_only": 3,
    "website_only": 0,
}
VERTICAL_MULTIPLIERS = {"food": 1.3, "fragrance": 1.2, "nutraceutical": 1.15, "pharma": 1.1, "flavor": 1.0}
UNKNOWN_MULTIPLIER = 0.8
TIER_FLOORS = {"HOT": 70, "WARM": 45, "NURTURE": 25}
BOTTOM_TIER = "PARK"
STATUSES = ["NEW", "QUEUED", "CONTACTED", "ENGAGED", "QUOTED", "WON", "LOST", "PARKED"]


@dataclass(frozen=True)
class Settings:
    """Everything a run can be tuned with. Dimensions are small and fixed-size."""

    state_lists: dict = field(default_factory=lambda: dict(STATE_LISTS))
    default_state_list: str | None = DEFAULT_STATE_LIST
    vertical_keywords: dict = field(default_factory=lambda: dict(VERTICAL_KEYWORDS))
    signal_terms: list = field(default_factory=lambda: list(SIGNAL_TERMS))
    import_keywords: dict = field(default_factory=lambda: dict(IMPORT_KEYWORDS))
    channel_points: dict = field(default_factory=lambda: dict(CHANNEL_POINTS))
    signal_points: dict = field(default_factory=lambda: dict(SIGNAL_POINTS))
    state_points: dict = field(default_factory=lambda: dict(STATE_POINTS))
    contact_points: dict = field(default_factory=lambda: dict(CONTACT_POINTS))
    vertical_multipliers: dict = field(default_factory=lambda: dict(VERTICAL_MULTIPLIERS))
    unknown_multiplier: float = UNKNOWN_MULTIPLIER
    tier_floors: dict = field(default_factory=lambda: dict(TIER_FLOORS))
    user_blocked: tuple = ()
    revenue_min: int | None = 5_000_000
    revenue_max: int | None = 500_000_000
    max_pages: int = 4
    max_contact_searches: int = 100
    max_verifications: int = 50
