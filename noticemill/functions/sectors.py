"""Sectors from the industry field, else from the company's name: ordered keyword lists, first match wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Keywords in the industry field.
BY_INDUSTRY = (
    ("Technology", ("tech", "information", "software", "computer")),
    ("Healthcare", ("health", "hospital", "medical", "pharma")),
    ("Retail", ("retail", "food service", "restaurant", "hotel", "accommodation")),
    ("Manufacturing", ("manufactur", "aerospace", "defense")),
    ("Finance", ("finance", "bank", "insurance", "real estate")),
    ("Education", ("education", "school", "university", "college")),
    ("Government/Non-profit", ("government", "public admin", "nonprofit")),
)
# Keywords in the company's name; blanks count.
BY_NAME = (
    ("Technology", ("amazon", "google", "meta", "apple", "intel", "ibm", "microsoft", "nvidia", "cisco", "oracle", "salesforce", "tech", "software", "semiconductor", "ai ", " ai,", "data", "digital", "cyber")),
    ("Healthcare", ("hospital", "health", "medical", "pharma", "clinic", "care", "biotech", "bio ", "therapeutics", "labs", "laboratory")),
    ("Retail", ("retail", "store", "market", "shop", "walmart", "target", "costco", "grocery", "food", "restaurant", "cafe", "hotel", "hilton")),
    ("Manufacturing", ("manufactur", "factory", "plant", "production", "assembly", "aerospace", "defense", "automotive", "auto ", "motor")),
    ("Finance", ("bank", "financial", "insurance", "capital", "fund", "invest", "mortgage", "credit", "loan")),
    ("Education", ("university", "college", "school", "education", "academic", "institute", "learning")),
    ("Government/Non-profit", ("county", "city of", "state of", "public", "nonprofit", "foundation", "agency")),
)


def _first_match(x: Column, lists: tuple, otherwise: Column) -> Column:
    lower = F.lower(x)
    any_of = lambda words: reduce(lambda a, b: a | b, [lower.contains(w) for w in words])
    (name, words), *more = lists
    chain = F.when(any_of(words), F.lit(name))
    for name, words in more:
        chain = chain.when(any_of(words), F.lit(name))
    return chain.otherwise(otherwise)


def is_given(industry: Column) -> Column:
    field = strip(F.coalesce(industry, F.lit("")))
    return (field != "") & (field != "nan")


def sector(industry: Column, company: Column) -> Column:
    """An industry that no list knows stays, cut to 40 characters."""
    field = strip(F.coalesce(industry, F.lit("")))
    return F.when(is_given(industry), _first_match(field, BY_INDUSTRY, F.substring(field, 1, 40))).otherwise(_first_match(company, BY_NAME, F.lit("Other")))
