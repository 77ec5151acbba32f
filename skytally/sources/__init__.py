"""Inputs: parquet tables, derived flight lines, text/Kafka line sources."""

from skytally.sources.flights import (
    defect_itinerary_lines,
    defect_on_time_lines,
    flights,
    itinerary_lines,
    on_time_lines,
)
from skytally.sources.lines import (
    file_line_stream,
    kafka_line_stream,
    kafka_options,
    text_lines,
    write_lines,
)
from skytally.sources.tables import read_table

__all__ = [
    "defect_itinerary_lines",
    "defect_on_time_lines",
    "file_line_stream",
    "flights",
    "itinerary_lines",
    "kafka_line_stream",
    "kafka_options",
    "on_time_lines",
    "read_table",
    "text_lines",
    "write_lines",
]
