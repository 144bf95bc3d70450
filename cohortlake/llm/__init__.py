"""Operators for preparing training text: mixing, chat linking, personal data,
secrets, quality, toxicity, decontamination, web archives and near duplicates.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Helpers run inside tasks travel with the job, so the workers need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
