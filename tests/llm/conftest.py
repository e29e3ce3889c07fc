"""The library's Spark session serves these tests as well."""
