"""Operators for training-data corpora, and their queries.

Nothing outside this package imports it. Functions that run in Python workers
travel with the task (``ship``), so executors need only the third-party libraries.
"""

import sys

from opspark.session import ship

ship(sys.modules[__name__])
