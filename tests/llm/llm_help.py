def by_id(df, *columns, key="doc_id"):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}
