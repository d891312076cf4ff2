"""The named queries and, where SQL can say the same, their SQL."""


def all_queries():
    from newsloom.plans import articles, feed, files, vectors

    return {**articles.QUERIES, **feed.QUERIES, **files.QUERIES, **vectors.QUERIES}


def all_oracles():
    from newsloom.plans import articles, feed, files, vectors

    return {**articles.ORACLES, **feed.ORACLES, **files.ORACLES, **vectors.ORACLES}
