"""Training-data operators: line dedup, quality, language, mixing, near-dedup, URLs, tokens, fingerprints.

Nothing else in wattlake imports this subpackage; it imports only general
helpers (the session's shared scratch folder).  ``queries`` holds the
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage that run in tasks travel with the task: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
