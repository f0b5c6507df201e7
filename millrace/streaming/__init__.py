"""Nothing to build: the log operators in ``millrace.operators.weblog`` are stateless
projections and filters, so they take a streaming DataFrame as it is
(``tests/test_streaming.py``).
"""
