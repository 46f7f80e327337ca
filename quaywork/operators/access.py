"""Effective permissions over users, groups and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def effective_permissions(
    user_roles: DataFrame,
    user_groups: DataFrame,
    group_roles: DataFrame,
    role_permissions: DataFrame,
    permissions: DataFrame,
    user: str | None = None,
) -> DataFrame:
    """Distinct permissions of every user, through own roles and group roles."""
    if user is not None:
        user_roles = user_roles.where(F.col("UserOid") == user)
        user_groups = user_groups.where(F.col("UserOid") == user)
    inherited = user_groups.join(group_roles, "GroupId").select("UserOid", "RoleId")
    roles = user_roles.select("UserOid", "RoleId").union(inherited).distinct()
    granted = role_permissions.join(permissions, "PermissionId").select("RoleId", "PermissionName")
    return roles.join(granted.distinct(), "RoleId").select("UserOid", "PermissionName").distinct()


def role_matrix(roles: DataFrame, role_permissions: DataFrame, permissions: DataFrame) -> DataFrame:
    return (
        role_permissions.join(roles, "RoleId")
        .join(permissions, "PermissionId")
        .select("RoleName", "PermissionName")
    )


def users_with_any(effective: DataFrame, any_of: list[str]) -> DataFrame:
    """Users holding at least one of the permissions."""
    return effective.where(F.col("PermissionName").isin(any_of)).select("UserOid").distinct()


def check_permission(users: DataFrame, effective: DataFrame, any_of: list[str]) -> DataFrame:
    allowed = users_with_any(effective, any_of).withColumn("Allowed", F.lit(True))
    return users.join(allowed, "UserOid", "left").select(
        "UserOid", F.coalesce("Allowed", F.lit(False)).alias("Allowed")
    )
