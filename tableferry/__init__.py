"""Move tables between databases, files and the Spark catalog."""

from tableferry.functions.ewkb import parse_ewkb, parse_geometry
from tableferry.functions.geometry import is_valid, parse_wkt, to_wkt
from tableferry.functions.names import as_flag, clean_name, clean_names
from tableferry.functions.text import empty_as_null, escape_quotes, na_as_null, strip_unsafe
from tableferry.functions.types import apply_type_map, infer_types
from tableferry.operators.batches import append_once
from tableferry.operators.geocolumn import add_geometry, add_geometry_column, null_geometry
from tableferry.operators.id_blocks import reserve_ids
from tableferry.operators.ids import (
    append_numbered,
    assign_ids,
    find_id_column,
    key_violations,
    max_value,
    next_id,
    number_rows,
    table_max,
)
from tableferry.operators.keys import append_unique, appended_violations, build_key_summary
from tableferry.operators.statements import (
    add_column,
    delete_where,
    drop_column,
    run_statement,
    update_where,
)
from tableferry.plans.upload import (
    insert_values,
    load_csv,
    load_excel,
    load_json,
    upload,
    upload_geo,
    upload_lite,
    upload_typed,
)
from tableferry.session import get_session
from tableferry.sinks.delimited import read_delimited, write_delimited
from tableferry.sinks.tables import create_empty, rewrite_table, save_table
from tableferry.sources.files import read_csv, read_json
from tableferry.sources.relation import (
    TableSource,
    filter_frame,
    list_columns,
    list_tables,
    materialize,
    postgresql,
    read_geometry,
    read_relation,
    register_jdbc_catalog,
    run_query,
    table_exists,
)
from tableferry.sources.workbooks import read_excel

__all__ = [name for name in dir() if not name.startswith("_")]
