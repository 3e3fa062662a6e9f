"""Training-data operators (dedup, licences, chat, language, packing, WARC, ...).

Nothing else in the library imports this subpackage.  Functions that run on
executors travel with their code, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
