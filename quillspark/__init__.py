"""A PySpark engine for collections of scholarly full texts."""
