"""The catalog: which tables there are and how their records relate."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from changelake.sources.readers import table_reader

DEFAULT_MODULE = "core"


@dataclass(frozen=True)
class Relation:
    """How records of one registry reach records of another.

    * to one: ``column`` of this registry holds the target's id;
    * to many, reverse: ``column`` *of the target* holds this registry's id (``many=True``);
    * to many, link: rows of the table ``link`` pair ``column`` (this id) with ``target_column``.
    """

    target: str
    column: str
    many: bool = False
    link: str | None = None
    target_column: str | None = None


@dataclass(frozen=True)
class Registry:
    """A table of records. ``load`` is called for every use, so that a stream sees the current snapshot."""

    name: str
    table_name: str
    load: Callable[[], DataFrame]
    relations: Mapping[str, Relation] = field(default_factory=dict)
    json_fields: frozenset[str] = frozenset()


def registry_name(name: str, aliases: Mapping[str, str] | None = None) -> str:
    """``module.model`` in lower case, with the default module filled in."""
    module, _, model = name.strip().lower().rpartition(".")
    module = (aliases or {}).get(module, module) or DEFAULT_MODULE
    return f"{module}.{model}"


class Catalog:
    """Registries by name, link tables, and the write log."""

    def __init__(
        self,
        registries: Iterable[Registry],
        log: Callable[[], DataFrame] | None = None,
        links: Mapping[str, Callable[[], DataFrame]] | None = None,
        module_aliases: Mapping[str, str] | None = None,
    ) -> None:
        self.module_aliases = dict(module_aliases or {})
        self._registries = {registry_name(r.name, self.module_aliases): r for r in registries}
        self._log = log
        self._links = dict(links or {})

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        root: str,
        registries: Mapping[str, str],
        *,
        relations: Mapping[str, Mapping[str, Relation]] | None = None,
        json_fields: Mapping[str, Iterable[str]] | None = None,
        links: Iterable[str] = (),
        log: str | None = "write_log",
    ) -> Catalog:
        """A catalog over a directory with one Parquet table per name; ``registries`` maps names to tables."""

        def reader(table: str) -> Callable[[], DataFrame]:
            return table_reader(spark, f"{root.rstrip('/')}/{table}")

        return cls(
            [
                Registry(
                    name, table, reader(table), (relations or {}).get(name, {}),
                    frozenset((json_fields or {}).get(name, ())),
                )
                for name, table in registries.items()
            ],
            reader(log) if log else None,
            {table: reader(table) for table in links},
        )

    def names(self) -> list[str]:
        return sorted(self._registries)

    def registry(self, name: str | Registry) -> Registry:
        if isinstance(name, Registry):
            return name
        full = registry_name(name, self.module_aliases)
        if full not in self._registries:
            module = full.partition(".")[0]
            known = [n for n in self.names() if n.startswith(module + ".")]
            raise ValueError(
                f"no registry {full!r}; known: {known or self.names()}"
                if known
                else f"no module {module!r}; known: {sorted({n.partition('.')[0] for n in self.names()})}"
            )
        return self._registries[full]

    def load(self, name: str | Registry) -> DataFrame:
        return self.registry(name).load()

    def link(self, table: str) -> DataFrame:
        if table not in self._links:
            raise ValueError(f"no link table {table!r}; known: {sorted(self._links)}")
        return self._links[table]()

    def log(self) -> DataFrame:
        if self._log is None:
            raise ValueError("the catalog has no write log")
        return self._log()

    def foreign_keys(self, name: str | Registry) -> list[str]:
        """Columns of a registry that hold ids of other records."""
        registry = self.registry(name)
        return sorted({r.column for r in registry.relations.values() if not r.many and r.link is None})

    def describe(self) -> dict[str, dict[str, dict[str, object]]]:
        """``{module: {model: {"table_name": ..., "fields": {name: type}}}}`` from the tables' own schemas."""
        described: dict[str, dict[str, dict[str, object]]] = {}
        for name, registry in sorted(self._registries.items()):
            module, _, model = name.partition(".")
            fields = {f.name: f.dataType.simpleString() for f in registry.load().schema}
            fields |= {name: relation.target for name, relation in registry.relations.items()}
            described.setdefault(module, {})[model] = {"table_name": registry.table_name, "fields": fields}
        return described
