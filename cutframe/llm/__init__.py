"""Training-data operators: distributed jobs over corpora, vectors, pages and conversations.

Nothing outside this folder imports it; `queries.py` holds the registered queries.
"""
