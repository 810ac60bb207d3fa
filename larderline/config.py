"""Rules and thresholds of every job, as frozen objects passed to the jobs.

No transform holds a threshold of its own: a caller overrides one with
``dataclasses.replace``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping


def _frozen(d: dict) -> Mapping:
    return field(default_factory=lambda: MappingProxyType(d))


@dataclass(frozen=True)
class PlaceRules:
    """Place index: home point, duplicate distance, categories, expansion areas."""

    # fixed values: the published index is computed from these
    home: tuple[float, float] = (37.79960, -122.40740)
    metres_per_minute: float = 80.0
    duplicate_m: float = 150.0
    expansion: tuple[str, ...] = ("North Beach", "Chinatown", "Fisherman's Wharf", "Russian Hill")
    split_names: tuple[str, ...] = ("North Beach", "Russian Hill")
    split_label: str = "Fisherman's Wharf"
    local_grocery: tuple[str, ...] = (
        "supermarket", "greengrocer", "convenience", "deli", "butcher", "seafood", "bakery",
        "health_food", "frozen_food", "tea", "coffee", "wine", "alcohol",
    )
    citywide_grocery: tuple[str, ...] = (
        "supermarket", "greengrocer", "convenience", "grocery", "health_food", "butcher",
        "seafood", "bakery", "deli",
    )
    display_order: tuple[str, ...] = (
        "North Beach", "Chinatown", "Fisherman's Wharf", "Russian Hill", "Nob Hill",
        "Financial District/South Beach",
    )
    earth_m: float = 6371000.0


@dataclass(frozen=True)
class RiskRules:
    """Incidents near a place: radius, window, and the three category buckets."""

    radius_m: float = 150.0
    window_days: int = 365
    pull_pad_m: float = 200.0
    box: tuple[float, float] = (0.006, 0.0075)  # half height and width, degrees, for the nearest incident
    top_categories: int = 5
    # fixed values: category names as the incident data prints them
    buckets: Mapping[str, tuple[str, ...]] = _frozen({
        "violent": ("Assault", "Robbery", "Homicide", "Rape", "Sex Offense", "Weapons Offense",
                    "Weapons Carrying Etc"),
        "property": ("Larceny Theft", "Burglary", "Motor Vehicle Theft", "Malicious Mischief",
                     "Stolen Property", "Vandalism"),
        "drug": ("Drug Offense", "Drug Violation", "Disorderly Conduct", "Prostitution"),
    })

    @property
    def months(self) -> float:
        return self.window_days / 30.4375


@dataclass(frozen=True)
class MatchRules:
    """Entity match of places against inspected businesses."""

    # fixed values: distances in metres, document frequencies, similarity ratios
    same_m: float = 120.0
    near_m: float = 400.0
    conflict_m: float = 1000.0
    df_distinct: int = 20
    df_unique: int = 3
    fuzzy_ratio: float = 0.85
    fuzzy_strong: float = 0.90
    min_shared: int = 2
    min_identity: int = 2
    rejected_kept: int = 6
    first_block: int = 256   # registrations, in order of their ids, that each place may meet for its rejected list,
    block_growth: int = 8    # times as many in each next block, for the places whose list isn't full
    # fixed values: words without identity, and words that only name an area
    stop_words: tuple[str, ...] = (
        "the", "restaurant", "cafe", "caffe", "and", "inc", "llc", "co", "corp", "company", "ltd",
        "dba", "of", "by", "at", "on",
    )
    place_words: tuple[str, ...] = (
        "north", "beach", "chinatown", "san", "francisco", "sf", "telegraph", "hill", "nob",
        "russian", "columbus", "grant", "stockton", "broadway", "wharf", "fisherman", "pier",
        "embarcadero", "washington", "square", "jackson", "pacific", "powell", "kearny", "bay",
        "union", "new",
    )
    area_zips: tuple[str, ...] = ("94102", "94104", "94105", "94108", "94109", "94111", "94133")


# fixed values: dataset ids of the three inspection eras
ERA_SCORED = "pyih-qa8i"
ERA_PLACARD = "5tti-66ds"
ERA_CURRENT = "tvy3-wexg"


@dataclass(frozen=True)
class VoteRules:
    samples: int = 3
    agree_yes: int = 2
    agree_no: int = 3
    # fixed values: the attribute vocabulary, in reading order
    attributes: tuple[str, ...] = (
        "fried", "spicy", "acidic", "nuts", "seeds", "raw", "fiber_high", "sodium_high",
        "sugar_high",
    )


SURVEY = "Survey (FNDDS)"


@dataclass(frozen=True)
class FoodRules:
    """Retrieval of food records for items, and the decision taken from readings."""

    samples: int = 3
    agree_map: int = 3
    agree_portion: int = 2
    per_pool: int = 8
    max_portions: int = 4
    name_weight: float = 1.0
    description_weight: float = 0.5
    section_weight: float = 0.25
    prefix_length: int = 5
    prefix_weight: float = 0.5
    common_df: int = 100_000  # has no effect: pairs are scored where the food lies, whatever token they share
    # fixed values: categories, words and food groups as the food data prints them
    single_exclude: tuple[str, ...] = (
        "Fast Foods", "Restaurant Foods", "Meals, Entrees, and Side Dishes", "Baby Foods",
    )
    aliases: Mapping[str, str] = _frozen({
        "prawn": "shrimp", "fettuccine": "pasta", "penne": "pasta", "linguine": "pasta",
        "linguini": "pasta", "rigatoni": "pasta", "tagliatelle": "pasta", "pappardelle": "pasta",
        "bolognese": "meat sauce", "pomodoro": "tomato sauce", "marinara": "tomato sauce",
        "nigiri": "sushi", "maki": "sushi roll", "sashimi": "raw fish", "hamachi": "yellowtail",
        "burrata": "mozzarella", "matcha": "green tea", "americano": "coffee", "brew": "coffee",
        "frappuccino": "coffee blended", "refresher": "fruit drink", "donut": "doughnut",
        "omelette": "omelet", "kebab": "kabob", "gyoza": "dumpling", "udon": "noodles",
        "risotto": "rice", "margherita": "pizza cheese", "caprese": "tomato mozzarella",
        "cioppino": "seafood stew", "baguette": "french bread", "wun": "wonton", "tun": "wonton",
    })
    dish_categories: tuple[str, ...] = (
        "Bean, pea, legume dishes", "Burgers", "Burritos and tacos", "Cheese sandwiches",
        "Chicken fillet sandwiches", "Coleslaw, non-lettuce salads",
        "Deli and cured meat sandwiches", "Egg rolls, dumplings, sushi",
        "Egg/breakfast sandwiches", "Frankfurter sandwiches", "Fried rice and lo/chow mein",
        "Lettuce and lettuce salads", "Macaroni and cheese",
        "Mashed potatoes and white potato mixtures", "Meat and BBQ sandwiches",
        "Meat mixed dishes", "Nachos", "Not included in a food category",
        "Other Mexican mixed dishes", "Pasta mixed dishes, excludes macaroni and cheese",
        "Peanut butter and jelly sandwiches", "Pizza", "Poultry mixed dishes",
        "Ramen and Asian broth-based soups", "Rice mixed dishes", "Seafood mixed dishes",
        "Seafood sandwiches", "Soups, broth-based", "Soups, cream-based",
        "Stir-fry and soy-based sauce mixtures", "Vegetable dishes",
        "Vegetable sandwiches/burgers", "Vegetables on a sandwich",
    )


@dataclass(frozen=True)
class NutrientRules:
    # fixed values: nutrient ids per field in fallback order, and the bounds per 100 g
    fields: Mapping[str, tuple[int, ...]] = _frozen({
        "energy_kcal": (1008, 2047, 2048),
        "protein_g": (1003,),
        "fiber_g": (1079,),
        "sodium_mg": (1093,),
        "sugars_g": (2000, 1063),
        "fat_g": (1004,),
        "saturated_fat_g": (1258,),
        "carbohydrate_g": (1005,),
    })
    bounds: Mapping[str, tuple[float, float]] = _frozen({
        "energy_kcal": (0.0, 902.0),
        "protein_g": (0.0, 100.0),
        "fat_g": (0.0, 100.0),
        "carbohydrate_g": (0.0, 100.0),
        "fiber_g": (0.0, 100.0),
        "sugars_g": (0.0, 100.0),
        "saturated_fat_g": (0.0, 100.0),
        "sodium_mg": (0.0, 40000.0),
    })
    sum_fields: tuple[str, ...] = ("protein_g", "fat_g", "carbohydrate_g")
    sum_max: float = 105.0
    ids_per_request: int = 20


# fixed values: bulk release folder -> (data type in its food table, data type in the index)
FOOD_RELEASES: Mapping[str, tuple[str, str]] = MappingProxyType({
    "FoodData_Central_foundation_food_csv_2025-04-24": ("foundation_food", "Foundation"),
    "FoodData_Central_sr_legacy_food_csv_2018-04": ("sr_legacy_food", "SR Legacy"),
    "FoodData_Central_survey_food_csv_2024-10-31": ("survey_fndds_food", SURVEY),
})


@dataclass(frozen=True)
class FreshnessRules:
    max_age_days: int = 180
    warn_days: int = 30


@dataclass(frozen=True)
class VerdictRules:
    verdicts: tuple[str, ...] = ("pick", "ok", "treat")
    review_after_days: int = 365
    warn_days: int = 30
    undated_until: Mapping[str, str] = _frozen({})


@dataclass(frozen=True)
class DocumentRules:
    statuses: tuple[str, ...] = ("ok", "partial", "not_found", "skipped")
    basis_required_from: str = "2026-09-24"
    item_fields: tuple[str, ...] = ("section", "item", "price", "description")
    product_fields: tuple[str, ...] = (
        "section", "name", "description", "size", "price", "sold_by", "package_g", "package_ml",
        "units",
    )
    record_fields: tuple[str, ...] = (
        "fdcId", "dataType", "description", "publicationDate", "fetched_at", "nutrients",
        "portions",
    )


@dataclass(frozen=True)
class PackageRules:
    # fixed values: unit factors, which are definitions
    grams: Mapping[str, float] = _frozen(
        {"oz": 28.349523125, "lb": 453.59237, "g": 1.0, "kg": 1000.0})
    millilitres: Mapping[str, float] = _frozen(
        {"fl oz": 29.5735295625, "ml": 1.0, "l": 1000.0, "pint": 473.176473, "qt": 946.352946})
    pieces: Mapping[str, int] = _frozen({"each": 1, "doz": 12, "bag": 1})
    # fixed values: departments of a product feed that hold no food
    non_food: tuple[str, ...] = ("Everything Else", "Flowers & Plants", "Bouquets", "Plants")


@dataclass(frozen=True)
class PriceLevels:
    """Level of a place from the median price of its main sections."""

    below: tuple[float, ...] = (10.0, 18.0, 30.0)


# fixed values: (pattern, label) pairs of the text gate; a deployment adds its own identifiers
TOPIC_PATTERNS: tuple[tuple[str, str], ...] = (
    (r"\bhealth(?!_food\b)", "health"),
    (r"\bhealthy\b", "healthy"),
    (r"\bdiet(ary|s)?\b(?!\s+(coke|pepsi|dr\b|soda|sprite|7up|mountain|ginger|root))", "diet"),
    (r"\bnutrition(al)?\b", "nutrition"),
    (r"\bcalorie", "calorie"),
    (r"\ballerg", "allergen"),
    (r"\bmedical\b", "medical"),
    (r"\bmacros\b|\bpre-?gym\b|\bworkout\b", "regimen"),
)
EMAIL_PATTERNS: tuple[tuple[str, str], ...] = (
    (r"\b[a-z0-9._-]+@(gmail|icloud|me|hotmail|yahoo|outlook|proton)\.\w+\b", "personal email"),
)
