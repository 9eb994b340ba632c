"""kerbside: a PySpark-native analytics engine for fixed-camera movement data."""
