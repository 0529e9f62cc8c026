"""Data policy: what may leave, to whom."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes, providers that stay on the machine, providers that are known to send content away.
CLASSES = ("public", "internal", "restricted")
LOCAL = ("ollama", "replay", "recorded_replay", "local", "none")
CLOUD = ("azure", "openai", "aws", "bedrock", "anthropic", "gemini", "vertex")


def parsed_class(x: Column) -> Column:
    """P10: a known class, else restricted."""
    low = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return F.when(low.isin(*CLASSES), low).otherwise("restricted")


def egress_decision(provider: Column, *, data_class: Column, egress: Column, allowed: Column, known: tuple[str, ...] = CLOUD, local: tuple[str, ...] = LOCAL) -> Column:
    """Allow or deny, by the first rule that holds."""
    name = F.replace(F.lower(provider), F.lit("-"), F.lit("_"))
    listed = F.coalesce(F.array_contains(allowed, name), F.lit(False))
    return (
        F.when(name.isin(*local), "allow")
        .when(~name.isin(*known) & ~listed, "deny")
        .when(data_class == "restricted", "deny")
        .when(F.coalesce(egress, F.lit("")) != "allowed", "deny")
        .when((F.coalesce(F.size(allowed), F.lit(0)) > 0) & ~listed, "deny")
        .otherwise("allow")
    )
