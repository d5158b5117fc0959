"""Pipeline settings. A layer is one database (or folder) per environment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from jobstrata.contract import RAW

# Layer names, as they appear in database names and paths.
WORKLOAD = "workload"
LANDING = "landing"
CURATED = "curated"
FUNCTIONAL = "functional"
GOLD = "gold"

# Landing stored through the Hive Avro SerDe instead of a Spark data source.
HIVE_AVRO = "hive-avro"


@dataclass(frozen=True)
class TableConfig:
    """One source table and how the landing layer lays it out.

    ``quote_escape`` is what escapes a quote in the source: a backslash, or a quote where
    quotes are doubled.
    """

    name: str = "job_postings"
    source_file: str = "job_postings.csv"
    schema: T.StructType = RAW
    partitioned_by: tuple[str, ...] = ()
    dynamic_partitions: bool = True
    quote_escape: str = "\\"
    contract_path: str | None = None


@dataclass(frozen=True)
class LakeConfig:
    """Where the layers live and how they are written.

    With ``use_catalog`` every layer is a database with tables; otherwise a table is a
    folder below the layer's path. ``reset`` builds every table of a layer anew, beside the old one, which
    stays in use until then, and drops the layer's other tables at the end.
    ``verify`` is ``"content"`` or ``"count"``: whether the fingerprint of all values or only the
    number of rows of every sink is compared with what was written to it, and ``on_mismatch`` is
    ``"raise"`` or ``"warn"``: what to do where they differ.
    ``multi_line_source`` says that quoted values may hold newlines, and ``align_headers`` takes
    each file's columns by its own header instead of refusing other orders.
    With ``incremental`` the aggregate of a table whose landing partitions are replaced one by
    one is merged from states of the partitions, and only changed ones are read again.
    ``keep_rejects`` stores malformed source lines beside the raw table, and more than
    ``most_malformed_rows`` of them refuse the load.
    """

    source_path: str = ""
    env: str = "dev"
    username: str = "hadoop"
    base_path: str = "/user"
    tables: tuple[TableConfig, ...] = (TableConfig(),)
    aggregate_name: str = "impact_aggregated"
    use_catalog: bool = True
    reset: bool = False
    landing_format: str = "avro"
    on_mismatch: str = "raise"
    verify: str = "content"
    keep_rejects: bool = False
    most_malformed_rows: int | None = None
    incremental: bool = False
    multi_line_source: bool = False
    align_headers: bool = False
    single_csv: bool = False
    plain_csv: bool = False
    document_format: str = "json"
    document_options: Mapping[str, str] = field(default_factory=dict)

    def source(self, table: TableConfig) -> str:
        """Path of a table's source text; without ``source_path`` the file is a full path."""
        folder = self.source_path.rstrip("/")
        return f"{folder}/{table.source_file}" if folder else table.source_file

    def database(self, layer: str) -> str:
        return f"{self.env}_{layer}".lower()

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name.lower()}"

    def layer_path(self, layer: str) -> str:
        return f"{self.base_path.rstrip('/')}/{self.username}/datalake/{self.database(layer)}"

    def table_path(self, layer: str, name: str) -> str:
        return f"{self.layer_path(layer)}/{name.lower()}"

    def aggregate(self, table: TableConfig) -> str:
        """Functional table of ``table``; the first table has the plain name."""
        if table == self.tables[0]:
            return self.aggregate_name
        return f"{table.name.lower()}_{self.aggregate_name}"
