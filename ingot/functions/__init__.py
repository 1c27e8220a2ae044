"""Column builders.  Everything here returns ``pyspark.sql.Column`` expressions,
so rules compose into one projection and stay inside the JVM."""

from ingot.functions.nested import (  # noqa: F401
    at_path, compact_arrays, contains_array, drop_path, empty_value, ensure_array, fill_arrays,
    ensure_struct, placeholder_array, rename_keys, renamed_type,
)
from ingot.functions.jsonf import (  # noqa: F401
    is_json_object, is_blank, object_or_array, top_level_keys, unknown_keys,
)
from ingot.functions.text import (  # noqa: F401
    with_index_entries, with_inverted_index, with_reconstructed_text,
)
