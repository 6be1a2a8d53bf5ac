"""Folders of the test tables (a module name that no other test folder has)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
