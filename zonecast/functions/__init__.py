from zonecast.functions.scalar import *  # noqa: F401,F403
from zonecast.functions.stats import *  # noqa: F401,F403
