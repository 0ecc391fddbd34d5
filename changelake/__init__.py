"""Change-log and lineage analytics on Spark DataFrames."""

from changelake.plans.filters import And, Condition, F, FilterExpression, Or, all_of
from changelake.session import configure
from changelake.sources.catalog import Catalog, Registry, Relation

__all__ = ["And", "Catalog", "Condition", "F", "FilterExpression", "Or", "Registry", "Relation", "all_of", "configure"]
