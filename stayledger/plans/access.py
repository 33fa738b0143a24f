"""Row-level scope: which communities a caller may see, from already verified claims."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADMIN, REGIONAL, EXECUTIVE = "corporate_admin", "regional_director", "executive_director"


def scope(communities: DataFrame, claims: Mapping) -> DataFrame:
    """The caller's community ids. An unknown role or an empty scope is an error, never "all"."""
    role = claims.get("role")
    if role == ADMIN:
        granted = communities
    elif role == REGIONAL:
        granted = communities.filter(F.col("region") == F.lit(claims.get("region")))
    elif role == EXECUTIVE:
        granted = communities.filter(F.col("community_id") == F.lit(claims.get("community_id")))
    else:
        raise PermissionError("Unknown role")
    granted = granted.select("community_id")
    if granted.isEmpty():
        raise PermissionError("Token grants no community access")
    return granted


def narrow_to_community(granted: DataFrame, community_id) -> DataFrame:
    """The requested community, which has to lie inside the scope."""
    if community_id is None:
        return granted
    wanted = granted.filter(F.col("community_id") == F.lit(community_id))
    if wanted.isEmpty():
        raise PermissionError(f"Not authorized for community {community_id}")
    return wanted


def narrow_to_region(granted: DataFrame, communities: DataFrame, region) -> DataFrame:
    """The part of the scope inside a region; nothing in common is an error."""
    if region is None:
        return granted
    shared = granted.intersect(communities.filter(F.col("region") == F.lit(region)).select("community_id"))
    if shared.isEmpty():
        raise PermissionError(f"Not authorized for region {region}")
    return shared


def restrict(df: DataFrame, granted: DataFrame) -> DataFrame:
    """Rows of the scope's communities."""
    return df.join(granted, "community_id", "left_semi")


def whoami(communities: DataFrame, claims: Mapping) -> DataFrame:
    """The caller's user, role and visible communities."""
    return scope(communities, claims).select(
        F.lit(claims.get("sub")).alias("user"), F.lit(claims.get("role")).alias("role"), "community_id"
    )
