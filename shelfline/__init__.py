"""Product-catalogue jobs on Spark: landed shop pages in, a merged and exported catalogue out."""
