"""Training-data operators: near-duplicate search, personal data, decontamination,
quality, URL filtering, language-model scoring, chat formatting, token files,
packing and nearest neighbours.  Nothing else in the library imports this folder.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
