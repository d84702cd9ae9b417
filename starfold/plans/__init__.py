"""The warehouse model: adapter, dimension and fact transforms, quality
rules, the end-to-end load, and the registered queries with their SQL twins."""
