"""Column functions: they take and return Spark columns and never touch a session."""

from millrace.functions.buckets import hash_bucket
from millrace.functions.text import host_domain, item, item_from_end

__all__ = ["hash_bucket", "host_domain", "item", "item_from_end"]
