"""canopyspark: rasters, point clouds, cameras and run records as Spark relations."""
