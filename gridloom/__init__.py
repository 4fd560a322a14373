"""gridloom: scanned-document table analytics and corpus preparation as lazy Spark plans."""
