from tallystream.plans.incremental import (
    gold_of_increments,
    increments,
    read_increments,
    run_silver_increment,
)
from tallystream.plans.journal import Journal
from tallystream.plans.medallion import Layers, run_bronze, run_gold, run_medallion, run_silver

__all__ = [
    "Journal",
    "Layers",
    "gold_of_increments",
    "increments",
    "read_increments",
    "run_bronze",
    "run_gold",
    "run_medallion",
    "run_silver",
    "run_silver_increment",
]
