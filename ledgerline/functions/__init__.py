from ledgerline.functions.numeric import avg_half_up, half_up_div, pct, to_units
from ledgerline.functions.timeutil import ntz_lit
from ledgerline.functions.wire import to_wire

__all__ = ["avg_half_up", "half_up_div", "ntz_lit", "pct", "to_units", "to_wire"]
