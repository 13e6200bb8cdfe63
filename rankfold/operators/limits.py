"""Size limits that decide between plans; none of them changes a result.

Each can be set on the session, for instance
``spark.conf.set("spark.rankfold.broadcastBytes", "128m")``, or on a stage with
``setPlanLimits(broadcastBytes="128m")``, which goes first.
"""

from __future__ import annotations

import re
from collections.abc import Mapping as Options
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Limits:
    # Map literals are searched entry by entry: past this a hash join is faster.
    literal_labels: int = 16
    # A mapping within both is held by the driver instead of a written table.
    held_labels: int = 10_000
    held_bytes: int = 4 * 1024 * 1024
    # What a user reads back as a dict unless they say how much; pairs and table have no limit.
    collected_labels: int = 1_000_000
    # A mapping whose counted size is within this is sorted by one task, else by all.
    one_task_bytes: int = 64 * 1024 * 1024
    # What sorting over all executors may sample to the driver.
    sample_bytes: int = 256 * 1024 * 1024
    # A mapping whose counted size is within this is broadcast, else shuffled.
    broadcast_bytes: int = 128 * 1024 * 1024
    # Values with at least one in this many of the rows, so no more than this many
    # values, are spread over the shuffle; zero spreads none.
    hot_labels: int = 8192
    # Places that each of them is spread to.
    hot_spread: int = 64
    # 1: shuffled lookups show Catalyst that their keys are unique, and those whose index nobody
    # reads are left out of the plan. Adaptive execution cannot split such a join.
    prunable: int = 0
    # Most bytes of a bitmap of the known values that a shuffled lookup broadcasts, two for each
    # label: rows of other values then skip the shuffle. The rows are scanned twice for it, so
    # it is for tables that give the same rows each time; zero does without.
    known_bytes: int = 0
    # Counted size up to which a bucket of a dealt mapping is one task's hash table; a larger
    # mapping is dealt into more buckets. Zero keeps the number asked for, and sorts.
    bucket_bytes: int = 16 * 1024 * 1024

    @staticmethod
    def of(spark: SparkSession, own: Options[str, object] | None = None) -> "Limits":
        """The session's limits, with a stage's ``own`` in place of them."""
        own = own or {}
        names = {_option(f.name): f for f in fields(Limits)}
        if unknown := sorted(set(own) - set(names)):
            raise ValueError(f"no such limits: {', '.join(unknown)}; there are {', '.join(names)}")
        given = {}
        for option, field in names.items():
            setting = f"spark.rankfold.{option}"
            value = own.get(option, spark.conf.get(setting, None))
            given[field.name] = field.default if value is None else _amount(setting, value)
        return Limits(**given)


def _option(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(map(str.capitalize, rest))


# Powers of 1,024 for each unit of Spark's size strings.
_UNITS = {"b": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}


def _amount(setting: str, value: object) -> int:
    """A number, or a size string such as ``128m`` or ``64kb``."""
    found = re.fullmatch(r"(-?\d+)(?:([bkmgtp])b?)?", str(value).strip().lower())
    if found is None:
        raise ValueError(f"{setting} is a number or a size such as 128m, not {value!r}")
    return int(found[1]) * 1024 ** _UNITS[found[2] or "b"]
