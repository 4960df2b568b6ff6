"""Column-to-column functions. Everything here stays JVM-side."""
from .hexes import abi_array, hex_to_dec, hex_to_long, int_to_hex, word_address, words64
from .keys import surrogate_key
from .numbers import (bucket_1000, decimal_adjust, greatest_strict, per_item,
                      scale_down, try_number)
from .payload import at, jget, rpc_body, size0
from .text import (blank_null, dash_id, full_match, normalise_path, right_n,
                   selector, split_part)
from .times import epoch_hex_ts, epoch_ts, hour_of, micros, minus_hours

__all__ = [n for n in dir() if not n.startswith("_")]
