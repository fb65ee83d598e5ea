"""Column-level functions (pure Catalyst expressions, no Python per row)."""

from barsmith.functions.timefns import (epoch_micros, from_epoch_micros, floor_time,
                                        in_session, open_interval, to_ntz)
from barsmith.functions.parse import parse_bars, parse_wire, topic_name, with_symbol, wire_value

__all__ = ["epoch_micros", "from_epoch_micros", "floor_time", "in_session", "open_interval",
           "to_ntz", "parse_bars", "parse_wire", "topic_name", "with_symbol", "wire_value"]
