"""End-to-end plans over the test tables, with the SQL each is checked against."""
