"""Column functions with the meaning they have in the SQL dialects they come from."""

from rowloom.functions import dates, jsonpath, nulls, numbers, text

__all__ = ["dates", "jsonpath", "nulls", "numbers", "text"]
