"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from quarry.functions.text import (  # noqa: F401
    first_match, jvm_split, lines_of, regex_quote, split_multi, token_count,
)
from quarry.functions.binary import decode_payload, strip_header, to_text  # noqa: F401
from quarry.functions.nested import flatten_struct  # noqa: F401
