"""Sources: message readers, table-form inputs, framing and JSON decoding."""

from vigil.sources.tables import (events, long_readings, message_readings, read_table,
                                  wide_messages)

__all__ = ["events", "long_readings", "message_readings", "read_table", "wide_messages"]
