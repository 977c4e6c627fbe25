"""Operators for preparing the text of language-model training sets.

Nothing outside this subpackage imports it. Each module holds one operator; ``queries`` applies them to
whole tables. Functions are sent to the Python workers by value, so these need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
