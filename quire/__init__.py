"""quire: batch ranked text retrieval as Spark DataFrame plans.

Documents become a unigram + bigram index (postings, document frequencies,
document lengths, vector norms); multi-field topics become weighted term
bags; every topic of a batch is answered at once with length-normalised
TF-IDF scores, a weighted mix of the two gram orders, optional
pseudo-relevance feedback and a deterministic top-k per topic.
"""

from quire.functions.text import CHAR, WORD, Profile
from quire.operators.index import Index
from quire.operators.topics import TopicBatch
from quire.plans.search import search, search_legacy

__all__ = ["CHAR", "WORD", "Profile", "Index", "TopicBatch", "search", "search_legacy"]
