"""samplelake: labelled image datasets as Spark jobs.

List and validate objects, derive labels and sample keys, number samples into
shards, transform images, resume from a ledger, serve keyed lookups and shuffled
training batches.  Everything is a DataFrame in and a DataFrame out.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel with the job, so a cluster needs no
# separate install of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
