from opspark.functions.columns import *  # noqa: F401,F403
from opspark.functions.keys import *  # noqa: F401,F403
