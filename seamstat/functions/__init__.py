from seamstat.functions import codes, exprs  # noqa: F401
