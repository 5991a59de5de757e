"""Topic modelling as Spark jobs.

Every operator takes and returns DataFrames.  Tables are keyed by ``doc_id``:

    corpus(doc_id, text, ...)      tokens(doc_id, tokens)
    vectors(doc_id, vec)           knn(src, dst, rank, dist)
    doc_topics(doc_id, topic)      topic_words(topic, aspect, rank, word, score)
"""

import sys

from pyspark import cloudpickle

# Kernels travel to the Python workers by value, so executors do not need this
# package on their PYTHONPATH.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
