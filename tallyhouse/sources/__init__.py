"""Reading: landing folders, typed text files, tables behind JDBC."""
