"""Column expressions: money, time, ids, headers, retry rules, item lists."""
