"""Merchant contacts: posts to users to profiles to phone numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.text import extract_phones, phone_from_link


def distinct_users(posts: DataFrame, user: str = "username") -> DataFrame:
    return posts.select(user).dropna().distinct()


def with_contacts(profiles: DataFrame, biography: str, link: str, hashed: bool = False) -> DataFrame:
    """Phones found in the biography and in the external link."""
    return profiles.withColumns(
        {
            "phone_from_bio": extract_phones(F.col(biography), hashed),
            "phone_from_link": phone_from_link(F.col(link), hashed),
        }
    )


def merchant_enrich(posts: DataFrame, profiles: DataFrame, user: str, biography: str, link: str) -> DataFrame:
    """Profiles of the users seen in posts, with contacts."""
    return with_contacts(profiles.join(distinct_users(posts, user), user, "left_semi"), biography, link)
