"""Where things live: object roots, table names and the URIs made from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Layout:
    """Roots are URIs (`gs://bucket`, `file:///folder`, ...); tables are `project.group.name`."""

    raw_public: str
    public: str
    raw_user: str
    clean_user: str
    tables: str
    descriptors: str = "_descriptors"
    project: str = "project"
    raw_metadata: str = "raw_metadata"
    classification: str = "classification"

    def _uri(self, root: str, *names: Column | str) -> Column:
        parts = [F.lit(root.rstrip("/"))] + [n if isinstance(n, Column) else F.lit(n) for n in names]
        return F.concat_ws("/", *parts)

    def raw_public_uri(self, dataset: Column) -> Column:
        return self._uri(self.raw_public, dataset)

    def public_uri(self, dataset: Column) -> Column:
        return self._uri(self.public, dataset)

    def descriptor_uri(self, dataset: Column) -> Column:
        return self._uri(self.raw_public, self.descriptors.strip("/"), F.concat(dataset, F.lit(".yml")))

    @property
    def descriptors_root(self) -> str:
        return f"{self.raw_public.rstrip('/')}/{self.descriptors.strip('/')}"

    def table_name(self, group: str, name: str) -> str:
        return ".".join([self.project, group, name])

    def table_path(self, name: str) -> str:
        return f"{self.tables.rstrip('/')}/{name}"
