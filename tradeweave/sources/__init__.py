from tradeweave.sources.catalog import (
    catalog_snapshot,
    discover_fields,
    field_profile,
    read_catalog_snapshot,
    register_source,
    write_catalog_snapshot,
)
from tradeweave.sources.readers import (
    Branch,
    branch_view,
    combined_view,
    drop_id,
    global_view,
    global_view_keyed,
    id_as_string,
    ingest_csv,
    ingest_json,
    number_rows,
    read_documents,
    read_jdbc,
    read_relational,
)

__all__ = [
    "Branch",
    "branch_view",
    "catalog_snapshot",
    "combined_view",
    "discover_fields",
    "drop_id",
    "field_profile",
    "global_view",
    "global_view_keyed",
    "id_as_string",
    "ingest_csv",
    "ingest_json",
    "number_rows",
    "read_catalog_snapshot",
    "read_documents",
    "read_jdbc",
    "read_relational",
    "register_source",
    "write_catalog_snapshot",
]
