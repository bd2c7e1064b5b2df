from fleetpulse.functions.scalar import *  # noqa: F401,F403
from fleetpulse.functions.aggregates import *  # noqa: F401,F403
