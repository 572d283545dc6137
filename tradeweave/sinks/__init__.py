from tradeweave.sinks.bucketed import ROW, append_new_bucketed, rows_not_in
from tradeweave.sinks.contract import (
    MEDIATED,
    Contract,
    ContractError,
    append_validated,
    check_contract,
    coerce_to_contract,
    quarantine,
    rejects_report,
    split_fitting,
)
from tradeweave.sinks.keys import with_surrogate_key
from tradeweave.sinks.writers import (
    append,
    append_new_keyed,
    append_new_only,
    insert_values,
    overwrite,
    overwrite_many,
    write_with_count,
)

__all__ = [
    "MEDIATED",
    "Contract",
    "ContractError",
    "ROW",
    "append",
    "append_new_bucketed",
    "append_new_keyed",
    "append_new_only",
    "append_validated",
    "check_contract",
    "coerce_to_contract",
    "insert_values",
    "overwrite",
    "overwrite_many",
    "quarantine",
    "rejects_report",
    "rows_not_in",
    "split_fitting",
    "with_surrogate_key",
    "write_with_count",
]
