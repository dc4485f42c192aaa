"""Native Column expressions: time, geography, strings/arrays."""

from leadtime.functions.timeops import *  # noqa: F401,F403
from leadtime.functions.geo import *  # noqa: F401,F403
from leadtime.functions.text import *  # noqa: F401,F403
