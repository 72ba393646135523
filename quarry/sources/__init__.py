"""Batch sources, streaming sources and sinks."""

from quarry.sources.files import (  # noqa: F401
    literal_frame, number_range, parse_records, parse_vectors, read_delimited,
    read_events, read_libsvm, read_lines, read_table, rejected_records,
)
from quarry.sources.sinks import load_model, save_model, write_result  # noqa: F401
from quarry.sources.streams import (  # noqa: F401
    kafka_options, kafka_stream, lines_stream, messages_stream, socket_stream,
    table_stream,
)
