from lexloom.corpus import main

main()
