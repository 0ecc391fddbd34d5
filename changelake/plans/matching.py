"""Filter expressions as DataFrame operations.

One pass over the conditions decides which tables a filter needs:

* a relation to one record becomes one ``left`` join per distinct path, so any number of conditions below it
  share the join and ``|`` across relations stays one plan;
* a relation to many records becomes the set of matching ids: a ``left_semi`` join where the condition must
  hold, a flag by ``left`` join below ``|``;
* a count becomes a grouped count and a ``left`` join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as S
from pyspark.sql import types as T

from changelake.functions import jsoncols as J
from changelake.plans.filters import OPERATORS, And, Condition, FilterExpression, Or
from changelake.plans.joins import distinct_ids
from changelake.plans.once import computed_once
from changelake.sources.catalog import Catalog, Registry, Relation

# -- conditions on one column --------------------------------------------------------------------------


def _operand(kind: T.DataType, value) -> Column | None:
    """The operand as a literal of the column's family; ``None`` when the types can't be equal."""
    if isinstance(kind, T.BooleanType):
        return S.lit(value) if isinstance(value, bool) else None
    if isinstance(value, bool):
        return None
    if isinstance(kind, T.NumericType):
        return S.lit(value) if isinstance(value, (int, float)) else None
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return S.lit(value).try_cast(kind) if isinstance(value, str) else None
    return S.lit(value) if isinstance(value, str) else None


def column_condition(column: Column, kind: T.DataType, operator: str, value) -> Column:
    """A condition on a plain column; a null result counts as no match."""
    if operator == "isnull":
        return column.isNull() if value else column.isNotNull()
    if operator in ("in", "notin"):
        members = [m for m in (_operand(kind, v) for v in value if v is not None) if m is not None]
        inside = column.isin(members) if members else S.lit(False)
        if None in value:
            inside = column.isNull() | inside
        return inside if operator == "in" else column.isNotNull() & ~inside
    if operator == "contains" and isinstance(kind, T.ArrayType):
        member = _operand(kind.elementType, value)
        return S.array_contains(column, member) if member is not None else S.lit(False)
    if operator in ("startswith", "endswith", "contains"):
        if not isinstance(kind, T.StringType) or not isinstance(value, str):
            return S.lit(False)
        return {"startswith": column.startswith, "endswith": column.endswith, "contains": column.contains}[operator](value)
    if value is None:  # from the JSON form, where null is an ordinary operand
        return column.isNull() if operator == "eq" else column.isNotNull()
    operand = _operand(kind, value)
    if operand is None:
        return S.lit(operator == "ne")
    return OPERATORS[operator].column(column, operand)


def json_condition(variant: Column, operator: str, value, *, null_is_notin: bool = False) -> Column:
    """A condition on a JSON value, strict in types and never null.

    ``null_is_notin``: whether null counts as *not in* a list, as it does on a logged previous row.
    """
    if operator == "isnull":
        return J.is_null(variant) if value else ~J.is_null(variant)
    if operator == "eq":
        return J.equals(variant, value)
    if operator == "ne":
        return ~J.equals(variant, value)
    if operator in ("in", "notin"):
        inside = S.lit(False)
        for member in value:
            inside = inside | J.equals(variant, member)
        if operator == "in":
            return inside
        return ~inside if null_is_notin else ~inside & ~J.is_null(variant)
    text = J.as_string(variant)
    if operator == "contains":
        elements = S.try_variant_get(variant, "$", "array<variant>")
        found = S.exists(elements, lambda element: J.equals(element, value))
        if isinstance(value, str):
            found = S.coalesce(text.contains(value), found)
    elif operator in ("startswith", "endswith"):
        found = text.startswith(value) if operator == "startswith" else text.endswith(value)
    else:
        found = OPERATORS[operator].column(text if isinstance(value, str) else J.as_number(variant), S.lit(value))
    return S.coalesce(found, S.lit(False))


# -- conditions on a logged previous row ---------------------------------------------------------------


def previous_row_matches(node: FilterExpression | None, row: Column) -> Column:
    """Whether a filter on direct fields matches a previous row, given as a variant.

    Fields are looked up as written, then with ``_id``. Conditions are tried in order and a field the row
    doesn't have rejects it, unless an earlier condition has decided the group.
    """
    if node is None:
        return S.lit(True)
    return S.coalesce(_previous(node, row), S.lit(False))


def _previous(node: FilterExpression, row: Column) -> Column:
    if isinstance(node, Condition):
        if not node.is_local:
            raise ValueError(f"{node.path!r} can't be read from a deleted row; only direct fields can")
        name = node.fields[0]
        value = S.coalesce(J.member(row, name), J.member(row, f"{name}_id"))
        return S.when(value.isNotNull(), json_condition(value, node.operator, node.value, null_is_notin=True))
    results = [_previous(member, row) for member in node.members]
    combined = results[-1]
    for result in reversed(results[:-1]):
        decided = ~result if isinstance(node, And) else result
        combined = S.when(result.isNull(), S.lit(None)).when(decided, S.lit(isinstance(node, Or))).otherwise(combined)
    return combined


# -- relations -----------------------------------------------------------------------------------------


def _relation(registry: Registry, name: str, path: str) -> Relation:
    if name not in registry.relations:
        raise ValueError(f"{path!r}: {registry.name} has no relation {name!r}; known: {sorted(registry.relations)}")
    return registry.relations[name]


def _is_many(relation: Relation) -> bool:
    return relation.many or relation.link is not None


def _field(registry: Registry, df: DataFrame, name: str, path: str) -> T.DataType:
    if name in df.columns:
        return df.schema[name].dataType
    if name in registry.relations:
        relation = registry.relations[name]
        own = f" or the column {relation.column!r}" if not _is_many(relation) else ""
        raise ValueError(f"{path!r} is a relation to {relation.target}: compare a field of it, e.g. {path + '.id'!r}{own}")
    raise ValueError(f"{path!r}: {registry.name} has no field {name!r}")


class _Matcher:
    """Collects the joins of one filter on one registry and builds its predicate."""

    def __init__(self, catalog: Catalog, registry: Registry, df: DataFrame) -> None:
        self.catalog, self.registry, self.df = catalog, registry, df
        self.columns = df.columns
        self.helpers = 0
        self.hops: dict[tuple[str, ...], tuple[Registry, set[str]]] = {}
        self.counts: dict[str, str] = {}
        self.parsed: dict[str, str] = {}

    def _helper(self) -> str:
        self.helpers += 1
        return f"__match_{self.helpers}"

    def _split(self, fields: list[str], path: str) -> tuple[list[Relation], list[Registry]]:
        registry, relations, registries = self.registry, [], [self.registry]
        for name in fields:
            relation = _relation(registry, name, path)
            registry = self.catalog.registry(relation.target)
            relations.append(relation)
            registries.append(registry)
        return relations, registries

    def plan(self, node: FilterExpression) -> None:
        """Note which columns are needed along each path of relations to one record."""
        for condition in node.conditions():
            relations, registries = self._split(condition.fields[:-1], condition.path)
            if condition.is_count or any(map(_is_many, relations)):
                continue
            for depth in range(len(relations)):
                prefix = tuple(condition.fields[: depth + 1])
                needed = condition.fields[-1] if depth == len(relations) - 1 else relations[depth + 1].column
                self.hops.setdefault(prefix, (registries[depth + 1], set()))[1].add(needed)

    @staticmethod
    def _hop_name(prefix: tuple[str, ...], column: str) -> str:
        return "__rel_" + "_".join(prefix) + f"_{column}"

    def join_hops(self) -> None:
        for prefix in sorted(self.hops, key=len):
            registry, needed = self.hops[prefix]
            parent = self.registry if len(prefix) == 1 else self.hops[prefix[:-1]][0]
            own = parent.relations[prefix[-1]].column
            key = own if len(prefix) == 1 else self._hop_name(prefix[:-1], own)
            target = registry.load()
            path = ".".join(prefix)
            for column in needed:
                _field(registry, target, column, f"{path}.{column}")
            renamed = [S.col(c).alias(self._hop_name(prefix, c)) for c in sorted(needed)]
            joined_id = self._hop_name(prefix, "_join")
            target = target.select(S.col("id").alias(joined_id), *renamed)
            self.df = self.df.join(target, S.col(key) == S.col(joined_id), "left").drop(joined_id)

    def parse_json(self, node: FilterExpression) -> None:
        """Parse each JSON column that conditions look into once per row."""
        for condition in node.conditions():
            relations, registries = self._split(condition.fields[:-1], condition.path)
            if condition.is_count or any(map(_is_many, relations)) or not _looks_inside(registries[-1], condition):
                continue
            *hops, field = condition.fields
            column = self._hop_name(tuple(hops), field) if hops else field
            _field(registries[-1], self.df, column, condition.path)
            self.parsed.setdefault(column, self._helper())
        if self.parsed:
            columns = {name: J.parsed(S.col(column)) for column, name in self.parsed.items()}
            self.df = computed_once(self.df, **columns)

    def predicate(self, node: FilterExpression, required: bool) -> Column | None:
        """The predicate of a node; ``None`` where a semi join has applied it already."""
        if isinstance(node, Condition):
            return self._leaf(node, required)
        must = required and (isinstance(node, And) or len(node.members) == 1)
        parts = [p for p in (self.predicate(member, must) for member in node.members) if p is not None]
        if not parts:
            return None
        combined = parts[0]
        for part in parts[1:]:
            combined = combined & part if isinstance(node, And) else combined | part
        return combined

    def _leaf(self, condition: Condition, required: bool) -> Column | None:
        relations, registries = self._split(condition.fields[:-1], condition.path)
        if condition.is_count:
            name = self.counts.get(condition.path)
            if name is None:
                name = self.counts[condition.path] = self._helper()
                counts = related_counts(self.catalog, self.registry, condition)
                counts = counts.select(S.col("id").alias(name + "_id"), S.col("n").alias(name))
                self.df = self.df.join(counts, S.col("id") == S.col(name + "_id"), "left").drop(name + "_id")
            operator = condition.operator.removeprefix("count_")
            return OPERATORS[operator].column(S.coalesce(S.col(name), S.lit(0)), S.lit(condition.value))
        if any(map(_is_many, relations)):
            ids = related_ids(self.catalog, self.registry, condition, condition.fields)
            name = self._helper()
            ids = ids.select(S.col("id").alias(name + "_id"), S.lit(True).alias(name))
            if required:
                self.df = self.df.join(ids, S.col("id") == S.col(name + "_id"), "left_semi")
                return None
            self.df = self.df.join(ids, S.col("id") == S.col(name + "_id"), "left").drop(name + "_id")
            return S.coalesce(S.col(name), S.lit(False))
        *hops, field = condition.fields
        column = self._hop_name(tuple(hops), field) if hops else field
        kind = _field(registries[-1], self.df, column, condition.path)
        parsed = S.col(self.parsed[column]) if column in self.parsed else None
        return leaf_condition(registries[-1], S.col(column), kind, condition, parsed)


def _looks_inside(registry: Registry, condition: Condition) -> bool:
    """Whether a condition reads the JSON in its field."""
    in_json = condition.fields[-1] in registry.json_fields and condition.operator != "isnull"
    return bool(condition.json_keys) or in_json


def leaf_condition(
    registry: Registry, column: Column, kind: T.DataType, condition: Condition, parsed: Column | None = None
) -> Column:
    """A condition on a field of a table in hand; ``parsed`` is its JSON, if parsed already."""
    if _looks_inside(registry, condition):
        variant = J.parsed(column) if parsed is None else parsed
        variant = J.member(variant, *condition.json_keys) if condition.json_keys else variant
        return json_condition(variant, condition.operator, condition.value)
    return column_condition(column, kind, condition.operator, condition.value)


def related_ids(catalog: Catalog, registry: Registry, condition: Condition, fields: list[str]) -> DataFrame:
    """Distinct ids of the records that reach, along ``fields``, a record matching the condition."""
    df = registry.load()
    name, rest = fields[0], fields[1:]
    if not rest:
        kind = _field(registry, df, name, condition.path)
        return df.where(leaf_condition(registry, S.col(name), kind, condition)).select("id")
    relation = _relation(registry, name, condition.path)
    target = catalog.registry(relation.target)
    if relation.many and len(rest) == 1:  # the condition is on the related table itself
        table = target.load()
        kind = _field(target, table, rest[0], condition.path)
        found = table.where(leaf_condition(target, S.col(rest[0]), kind, condition))
        return distinct_ids(found, relation.column, "id")
    ids = related_ids(catalog, target, condition, rest).select(S.col("id").alias("__target"))
    if relation.link is not None:
        link = catalog.link(relation.link)
        found = link.join(ids, link[relation.target_column] == S.col("__target"), "left_semi")
        return distinct_ids(found, relation.column, "id")
    if relation.many:
        found = target.load().join(ids, S.col("id") == S.col("__target"), "left_semi")
        return distinct_ids(found, relation.column, "id")
    return df.join(ids, df[relation.column] == S.col("__target"), "left_semi").select("id")


def related_counts(catalog: Catalog, registry: Registry, condition: Condition) -> DataFrame:
    """``(id, n)``: how many related records each record has; records without any are absent."""
    *hops, field = condition.fields
    at = registry
    for name in hops:
        at = catalog.registry(_relation(at, name, condition.path).target)
    if field in at.relations and field not in at.load().columns:  # the path ends at a relation: count its ids
        hops, field = [*hops, field], "id"
    return _counts(catalog, registry, hops, field, condition.path)


def _counts(catalog: Catalog, registry: Registry, hops: list[str], field: str, path: str) -> DataFrame:
    relation = _relation(registry, hops[0], path)
    target = catalog.registry(relation.target)
    if len(hops) > 1:
        below = _counts(catalog, target, hops[1:], field, path).select(S.col("id").alias("__target"), "n")
        if relation.link is not None:
            rows = catalog.link(relation.link).select(S.col(relation.column).alias("id"), S.col(relation.target_column).alias("__target"))
        elif relation.many:
            rows = target.load().select(S.col(relation.column).alias("id"), S.col("id").alias("__target"))
        else:
            rows = registry.load().select("id", S.col(relation.column).alias("__target"))
        return rows.join(below, "__target").groupBy("id").agg(S.sum("n").alias("n"))
    if relation.link is not None:
        rows = catalog.link(relation.link).select(S.col(relation.column).alias("id"), S.col(relation.target_column).alias("__value"))
        if field != "id":
            table = target.load().select(S.col("id").alias("__value"), S.col(field).alias("__field"))
            rows = rows.join(table, "__value").select("id", S.col("__field").alias("__value"))
    elif relation.many:
        rows = target.load().select(S.col(relation.column).alias("id"), S.col(field).alias("__value"))
    else:
        rows = registry.load().select("id", S.col(relation.column).alias("__value"))
    rows = rows.where(S.col("id").isNotNull() & S.col("__value").isNotNull())
    return rows.groupBy("id").agg(S.count(S.lit(1)).alias("n"))


def apply_filter(catalog: Catalog, registry: str | Registry, df: DataFrame, node: FilterExpression | None) -> DataFrame:
    """The rows of ``df`` (rows of the registry) that match."""
    if node is None:
        return df
    matcher = _Matcher(catalog, catalog.registry(registry), df)
    matcher.plan(node)
    matcher.join_hops()
    matcher.parse_json(node)
    predicate = matcher.predicate(node, required=True)
    matched = matcher.df if predicate is None else matcher.df.where(predicate)
    return matched.select(*[S.col(f"`{c}`") for c in matcher.columns])


def local_predicate(df: DataFrame, node: FilterExpression) -> Column:
    """A filter on direct and JSON fields of ``df`` as one Column, which Spark can push into a scan."""
    if isinstance(node, Condition):
        if len(node.fields) > 1 or node.is_count:
            raise ValueError(f"{node.path!r} needs other tables")
        name = node.fields[0]
        bare = Registry("rows", "rows", lambda: df)
        return leaf_condition(bare, S.col(name), _field(bare, df, name, node.path), node)
    parts = [local_predicate(df, member) for member in node.members]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined & part if isinstance(node, And) else combined | part
    return combined
